"""Databases without one: the statements, their order, and how tables are divided."""

import re
from contextlib import contextmanager
from datetime import date, datetime
from decimal import Decimal

import duckdb
import pytest
from pyspark.sql import functions as F
from small import SmallSource, make_rows

from tradewind import job
from tradewind.job import Config, run
from tradewind.schemas import RAW_KEYS, RAW_TABLES
from tradewind.sinks.publish import copy_to_database
from tradewind.sinks.tables import JdbcSink
from tradewind.sources.dialects import (
    Dialect,
    MySQL,
    PostgreSQL,
    SqlServer,
    block_ranges,
    dialect_of,
    hash_predicates,
    key_ranges,
    literal,
)
from tradewind.sources.tables import JdbcZone

PG = "jdbc:postgresql://host/db"


class Connection:
    """Records what is run, and may fail at a statement."""

    def __init__(self, fails_at=None):
        self.log, self.fails_at = [], fails_at

    def setAutoCommit(self, on):  # noqa: N802
        self.log.append(f"autocommit {on}")

    def createStatement(self):  # noqa: N802
        return self

    def execute(self, sql):
        self.log.append(sql)
        if self.fails_at and self.fails_at in sql:
            raise RuntimeError("refused")

    def executeQuery(self, sql):  # noqa: N802
        self.log.append(sql)
        return self

    def next(self):
        return True

    def getString(self, at):  # noqa: N802
        return "0003-1B-1"

    def commit(self):
        self.log.append("commit")

    def rollback(self):
        self.log.append("rollback")

    def close(self):
        self.log.append("close")


@pytest.fixture
def connection(monkeypatch):
    made = Connection()
    monkeypatch.setattr(JdbcZone, "connection", lambda self: made)
    return made


def test_options(spark, monkeypatch):
    monkeypatch.setenv("TRADEWIND_JDBC_USER", "reader")
    monkeypatch.setenv("TRADEWIND_JDBC_PASSWORD", "secret")
    zone = JdbcZone(spark, "jdbc:any", {"driver": "some.Driver"})
    common = {"user": "reader", "password": "secret", "driver": "some.Driver"}
    sizes = {"batchsize": "1000", "numPartitions": "16"}
    assert zone.write_properties() == sizes | common
    assert zone.read_properties() == {"fetchsize": "10000"} | common
    assert "secret" not in repr(zone)


def test_dialects():
    assert dialect_of(PG) == PostgreSQL() and dialect_of("jdbc:mariadb://h/d") == MySQL()
    assert dialect_of("jdbc:sqlserver://h") == SqlServer() and dialect_of("jdbc:h2:x") == Dialect()
    assert dialect_of("nothing") == Dialect()


def test_hash_predicates_cover_every_row_once():
    parts = hash_predicates("k", 3)
    assert len(parts) == 3 and parts[0].endswith("or k is null)")
    assert all(p.startswith("mod(abs(hashtext(k::text)::bigint), 3)") for p in parts[1:])


@pytest.mark.parametrize("blocks, partitions", [(0, 1), (1, 5), (10, 3), (100, 100), (7, 0)])
def test_block_ranges_cover_every_block_once(blocks, partitions):
    parts = block_ranges(blocks, partitions)
    edges = [[int(n) for n in re.findall(r"\((\d+),0\)", part)] for part in parts]
    assert edges[0][0] == 0 and len(edges[-1]) == 1
    assert all(a[1] == b[0] and a[0] < a[1] for a, b in zip(edges, edges[1:]))
    assert len(parts) <= max(1, partitions)


def test_literals():
    values = [3, 2.5, Decimal("1.10"), True, "it's", date(2020, 1, 2), datetime(2020, 1, 2, 3, 4, 5)]
    texts = ["3", "2.5", "1.10", "true", "'it''s'", "date '2020-01-02'"]
    assert [literal(v) for v in values] == [*texts, "timestamp '2020-01-02 03:04:05.000000'"]
    row = duckdb.connect().execute("select " + ", ".join(map(literal, values))).fetchone()
    assert row[4] == "it's" and row[5] == date(2020, 1, 2)


@pytest.mark.parametrize("keys", [
    list(range(1000)), [7] * 400 + list(range(600)), [None, None, 1], [], [5] * 9,
    [f"k'{i}" for i in range(300)] + [None],
])
@pytest.mark.parametrize("parts", [2, 5, 40])
def test_key_ranges_hold_every_row_once(keys, parts):
    """The statement for split points and the conditions, on an in-process engine."""
    db = duckdb.connect()
    kind = "varchar" if keys and isinstance(keys[0], str) else "bigint"
    db.execute(f"create table t (k {kind})")
    if keys:
        db.executemany("insert into t values (?)", [[k] for k in keys])
    lows = [r[0] for r in db.execute(Dialect().quantiles_sql("t", "k", parts, len(keys))).fetchall()]
    conditions = key_ranges("k", lows[1:])
    counts = [db.execute(f"select count(*) from t where {c}").fetchone()[0] for c in conditions]
    assert sum(counts) == len(keys) and len(conditions) <= parts
    if len(set(keys)) == len(keys) > parts:
        assert len(conditions) == parts and max(counts) <= -(-len(keys) // parts) + 1


def test_samples():
    assert "tablesample system (1.000000)" in PostgreSQL().quantiles_sql("t", "k", 10, 1_000_000)
    assert "rand() < 0.01" in MySQL().quantiles_sql("t", "k", 10, 1_000_000)
    assert "tablesample (1.000000 percent)" in SqlServer().quantiles_sql("t", "k", 10, 1_000_000)
    for dialect in (PostgreSQL(), MySQL(), SqlServer(), Dialect()):
        assert " from t where k is not null" in dialect.quantiles_sql("t", "k", 10, 500)


def test_tasks_follow_the_size(spark, monkeypatch):
    leaves = {"plain": [("plain", 1_000_000)], "empty": [("empty", 0)], "none": [],
              "parent": [(f"parent_{i}", 100 * 2**i) for i in range(12)]}
    monkeypatch.setattr(JdbcZone, "leaves", lambda self, name: leaves[name])
    zone = JdbcZone(spark, PG, split_by={"v": "k"}, partitions={"plain": 4})
    assert [len(c) for c in zone.parts("plain").values()] == [4]
    default = JdbcZone(spark, PG)
    assert [len(c) for c in default.parts("plain").values()] == [-(-1_000_000 // 16_384)]
    assert len(zone.parts("v")["v"]) == 32 and "hashtext(k::text)" in zone.parts("v")["v"][0]
    assert default.parts("empty") == {"empty": ["ctid >= '(0,0)'::tid"]}
    # A partitioned table: every partition, none of its ranges over the bound.
    parts = default.parts("parent")
    assert list(parts) == [name for name, _ in leaves["parent"]]
    for name, blocks in leaves["parent"]:
        assert blocks / len(parts[name]) <= 16_384


def test_leaves_of_partitioned_and_plain_tables():
    sql = PostgreSQL().leaves_sql("s.raw_orders")
    assert "pg_partition_tree('s.raw_orders') where isleaf" in sql
    assert sql.endswith("where not exists (select 1 from pg_partition_tree('s.raw_orders'))")


def test_other_databases_are_cut_by_key(spark, monkeypatch):
    asked = []

    def query(self, sql):
        asked.append(sql)
        if "count(*)" in sql:
            return spark.sql("select 3500000 n")
        return spark.range(4).select((F.col("id") * 10).alias("low")).orderBy("low")

    monkeypatch.setattr(JdbcZone, "query", query)
    zone = JdbcZone(spark, "jdbc:h2:x")
    conditions = zone.parts("raw_orders")["raw_orders"]
    key = RAW_KEYS["raw_orders"]
    assert conditions == [f"({key} < 10 or {key} is null)", f"{key} >= 10 and {key} < 20",
                          f"{key} >= 20 and {key} < 30", f"{key} >= 30"]
    assert "ntile(4)" in asked[1]
    assert JdbcZone(spark, "jdbc:h2:x", keys={}).parts("raw_orders") == {"raw_orders": ["1 = 1"]}
    assert set(RAW_KEYS) == set(RAW_TABLES)


def test_snapshot_statements(spark, connection):
    zone = JdbcZone(spark, PG)
    assert "sessionInitStatement" not in zone.read_properties()
    with zone.frozen("raw_orders", "raw_customers") as frozen:
        # Held open while it is read, and nothing was written.
        assert connection.log == [
            "autocommit False",
            "set transaction isolation level repeatable read read only",
            "select pg_export_snapshot()",
            "lock table raw_orders in access share mode",
            "lock table raw_customers in access share mode",
        ]
        joined = frozen.read_properties()["sessionInitStatement"]
        assert joined == (
            "set transaction isolation level repeatable read read only;"
            " set transaction snapshot '0003-1B-1'"
        )
    assert connection.log[-2:] == ["rollback", "close"]


def test_snapshot_ends_when_reading_fails(spark, connection):
    with pytest.raises(KeyError), JdbcZone(spark, PG).frozen():
        raise KeyError
    assert connection.log[-2:] == ["rollback", "close"]


def test_no_snapshot_elsewhere(spark, connection, caplog):
    zone = JdbcZone(spark, "jdbc:mysql://h/d")
    with zone.frozen("t") as same:
        assert same is zone
    assert connection.log == [] and "no shared snapshot" in caplog.text


def test_the_job_lands_its_inputs_within_the_snapshot(spark, tmp_path, monkeypatch):
    events = []

    class Source(SmallSource):
        @contextmanager
        def frozen(self, *names):
            events.append(("begin", names))
            yield self
            events.append(("end",))

    stage = job._stage
    monkeypatch.setattr(job, "_stage", lambda *a: (events.append(a[2]), stage(*a))[1])
    source = Source(spark, make_rows(1, False))
    assert run(spark, source, Config(f"{tmp_path}/a", land_inputs=True)).succeeded
    landed = events[1 : events.index(("end",))]
    assert events[0] == ("begin", tuple(RAW_TABLES)) and len(landed) == 5
    assert all(name.startswith("input_") for name in landed)
    events.clear()
    assert run(spark, source, Config(f"{tmp_path}/b")).succeeded
    assert ("end",) not in events


class Writes:
    """Stands for the JDBC writer: notes which table is written."""

    def __init__(self, monkeypatch, log):
        def stage(zone, df, name):
            df.write.format("noop").mode("overwrite").save()
            log.append(f"write {name}__new")
            return f"{name}__new"

        monkeypatch.setattr(JdbcZone, "stage", stage)


def test_replace_writes_beside_then_swaps(spark, connection, monkeypatch):
    Writes(monkeypatch, connection.log)
    assert JdbcSink(JdbcZone(spark, PG)).write(spark.range(7), "s.fact") == 7
    assert connection.log == [
        "write s.fact__new",
        "autocommit False",
        "drop table if exists s.fact__old",
        "alter table if exists s.fact rename to fact__old",
        "alter table s.fact__new rename to fact",
        "drop table if exists s.fact__old",
        "commit",
        "close",
    ]


def test_all_tables_are_swapped_in_one_transaction(spark, connection, monkeypatch, tmp_path):
    Writes(monkeypatch, connection.log)
    assert run(spark, SmallSource(spark, make_rows(1, False)), Config(str(tmp_path))).succeeded
    rows = copy_to_database(spark, str(tmp_path), JdbcSink(JdbcZone(spark, PG)))
    log = connection.log
    assert len(rows) == 8 and all(rows.values())
    first = log.index("autocommit False")
    assert first == 8 and all(line.startswith("write ") for line in log[:8])
    assert log.count("commit") == 1 and log[-2:] == ["commit", "close"]
    # No old table goes before all new ones are in place.
    last_rename = max(i for i, line in enumerate(log) if "__new rename" in line)
    drops = [i for i, line in enumerate(log) if line.startswith("drop") and i > last_rename]
    assert len(drops) == 8


def test_failed_swap_is_rolled_back(spark, connection, monkeypatch):
    Writes(monkeypatch, connection.log)
    connection.fails_at = "__new rename"
    with pytest.raises(RuntimeError):
        JdbcZone(spark, PG).replace(spark.range(1), "fact")
    assert connection.log[-2:] == ["rollback", "close"] and "commit" not in connection.log


def test_swaps_of_other_databases():
    one = {"a__new": "a", "b__new": "b"}
    mysql = MySQL().swap_sql(one)
    assert sum("rename table" in sql for sql in mysql) == 1
    assert "rename table a to a__old, a__new to a, b to b__old, b__new to b" in mysql
    server = SqlServer().swap_sql({"s.a__new": "s.a"})
    assert server[1:3] == [
        "if object_id('s.a') is not null exec sp_rename 's.a', 'a__old'",
        "exec sp_rename 's.a__new', 'a'",
    ]
    assert Dialect().swap_sql(one) is None
