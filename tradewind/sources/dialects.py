"""What differs between databases: dividing a table, reading it as of one moment, swapping tables.

All is SQL text; :class:`tradewind.sources.tables.JdbcZone` runs it.
"""

from __future__ import annotations

import datetime
import decimal
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

# Sampled keys per part that split points are taken from.
SAMPLE_PER_PART = 1000


def literal(value: object) -> str:
    """A key value as SQL."""
    if isinstance(value, bool):
        return "true" if value else "false"
    if isinstance(value, (int, float, decimal.Decimal)):
        return str(value)
    if isinstance(value, datetime.datetime):
        return f"timestamp '{value:%Y-%m-%d %H:%M:%S.%f}'"
    if isinstance(value, datetime.date):
        return f"date '{value:%Y-%m-%d}'"
    return "'" + str(value).replace("'", "''") + "'"


def key_ranges(key: str, lows: Sequence[object]) -> list[str]:
    """Disjoint conditions that cut at the given values; together they hold every row.

    The first is open below and holds the rows without key, the last is open above. Rows of one
    key value stay together.
    """
    points = [literal(value) for value in dict.fromkeys(lows)]
    if not points:
        return ["1 = 1"]
    inner = [f"{key} >= {a} and {key} < {b}" for a, b in zip(points, points[1:])]
    return [f"({key} < {points[0]} or {key} is null)", *inner, f"{key} >= {points[-1]}"]


def block_ranges(blocks: int, partitions: int) -> list[str]:
    """Disjoint PostgreSQL conditions that split a table by its storage blocks.

    Each reads its own blocks only. The last is open, for blocks added meanwhile. Every row
    version lies in one block. So a row is read once where all ranges are read in one snapshot;
    without, a row that is updated meanwhile may move and be read twice or not at all.
    """
    each = max(1, -(-blocks // max(1, partitions)))
    starts = list(range(0, max(1, blocks), each))
    conditions = []
    for i, start in enumerate(starts):
        below = f" and ctid < '({starts[i + 1]},0)'::tid" if i + 1 < len(starts) else ""
        conditions.append(f"ctid >= '({start},0)'::tid{below}")
    return conditions


def hash_predicates(key: str, partitions: int) -> list[str]:
    """Disjoint PostgreSQL conditions that split a table or view by the hash of any key type.

    The database scans the whole table for each; :func:`block_ranges` is cheaper for tables.
    """
    bucket = f"mod(abs(hashtext({key}::text)::bigint), {partitions})"
    first = f"({bucket} = 0 or {key} is null)"
    return [first] + [f"{bucket} = {i}" for i in range(1, partitions)]


@dataclass(frozen=True)
class Dialect:
    """A database of which standard SQL is known only.

    Tables are divided at quantiles of a key. There is no snapshot that several connections
    share, and no swap of tables that readers cannot see.
    """

    # Statements of the connection that holds a snapshot open; the last returns its name.
    snapshot_begin: tuple[str, ...] = ()

    def sampled(self, table: str, share: float) -> str:
        """The table, or about that share of its rows where the database can sample."""
        return table

    def count_sql(self, table: str) -> str:
        return f"select count(*) as n from {table}"

    def quantiles_sql(self, table: str, key: str, parts: int, rows: int) -> str:
        """Lowest key of each of ``parts`` equal parts of the keys, or of a sample of them."""
        share = min(1.0, parts * SAMPLE_PER_PART / max(1, rows))
        keys = f"select {key} as k from {self.sampled(table, share)} where {key} is not null"
        tiles = f"select k, ntile({parts}) over (order by k) as part from ({keys}) s"
        return f"select min(k) as low from ({tiles}) q group by part order by low"

    def snapshot_join(self, snapshot: str) -> str:
        """What a connection runs first to read in a snapshot that another holds open."""
        raise NotImplementedError

    def pin_sql(self, table: str) -> str | None:
        """What keeps a table from being rewritten while a snapshot is open."""
        return None

    def swap_sql(self, tables: Mapping[str, str]) -> list[str] | None:
        """Statements that put staged tables in place of others, ``{staged: final}``.

        Run in one transaction they are seen all at once. None: not possible.
        """
        return None


def _base(table: str) -> str:
    """A table's name without its schema, as renaming takes it."""
    return table.rpartition(".")[2]


@dataclass(frozen=True)
class PostgreSQL(Dialect):
    """Storage blocks of leaf partitions, exported snapshots, transactional renames."""

    snapshot_begin: tuple[str, ...] = (
        "set transaction isolation level repeatable read read only",
        "select pg_export_snapshot()",
    )

    def leaves_sql(self, table: str) -> str:
        """The tables that hold the rows, with their storage blocks; a plain table holds its own.

        A partitioned table has no blocks itself.
        """
        size = "current_setting('block_size')::bigint as blocks"
        tree = f"pg_partition_tree('{table}')"
        return (
            f"select relid::regclass::text as part, pg_relation_size(relid) / {size}"
            f" from {tree} where isleaf union all"
            f" select '{table}', pg_relation_size('{table}') / {size}"
            f" where not exists (select 1 from {tree})"
        )

    def sampled(self, table: str, share: float) -> str:
        return table if share >= 1 else f"{table} tablesample system ({100 * share:.6f})"

    def snapshot_join(self, snapshot: str) -> str:
        return (
            "set transaction isolation level repeatable read read only;"
            f" set transaction snapshot {literal(snapshot)}"
        )

    def pin_sql(self, table: str) -> str:
        return f"lock table {table} in access share mode"

    def swap_sql(self, tables: Mapping[str, str]) -> list[str]:
        out = []
        for staged, final in tables.items():
            old = f"{final}__old"
            out += [
                f"drop table if exists {old}",
                f"alter table if exists {final} rename to {_base(old)}",
                f"alter table {staged} rename to {_base(final)}",
            ]
        return out + [f"drop table if exists {final}__old" for final in tables.values()]


@dataclass(frozen=True)
class MySQL(Dialect):
    """Renames of several tables in one statement, which readers see at once."""

    def sampled(self, table: str, share: float) -> str:
        return table if share >= 1 else f"(select * from {table} where rand() < {share:.9f}) t"

    def swap_sql(self, tables: Mapping[str, str]) -> list[str]:
        olds = [f"{final}__old" for final in tables.values()]
        present = [f"create table if not exists {f} like {s}" for s, f in tables.items()]
        renames = [f"{f} to {f}__old, {s} to {f}" for s, f in tables.items()]
        drops = [f"drop table if exists {old}" for old in olds]
        return [*drops, *present, f"rename table {', '.join(renames)}", *drops]


@dataclass(frozen=True)
class SqlServer(Dialect):
    """Sampling by pages, transactional renames."""

    def sampled(self, table: str, share: float) -> str:
        return table if share >= 1 else f"{table} tablesample ({100 * share:.6f} percent)"

    def swap_sql(self, tables: Mapping[str, str]) -> list[str]:
        out = []
        for staged, final in tables.items():
            out += [
                f"drop table if exists {final}__old",
                f"if object_id('{final}') is not null"
                f" exec sp_rename '{final}', '{_base(final)}__old'",
                f"exec sp_rename '{staged}', '{_base(final)}'",
            ]
        return out + [f"drop table if exists {final}__old" for final in tables.values()]


# The part of a JDBC URL behind "jdbc:".
DIALECTS: dict[str, Dialect] = {
    "postgresql": PostgreSQL(),
    "mysql": MySQL(),
    "mariadb": MySQL(),
    "sqlserver": SqlServer(),
}


def dialect_of(url: str) -> Dialect:
    """The dialect of a JDBC URL."""
    return DIALECTS.get(url.split(":")[1] if ":" in url else "", Dialect())
