"""Stored tables: parquet folders, the catalog and JDBC databases."""

from __future__ import annotations

import logging
import os
from collections.abc import Iterable, Iterator, Mapping
from contextlib import contextmanager
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.schemas import RAW_KEYS
from tradewind.session import path_exists
from tradewind.sources.dialects import (
    Dialect,
    PostgreSQL,
    block_ranges,
    dialect_of,
    hash_predicates,
    key_ranges,
)

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class ParquetZone:
    """Tables stored as ``<root>/<table>`` parquet folders."""

    spark: SparkSession
    root: str

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))


@dataclass(frozen=True)
class CatalogZone:
    """Tables of a catalog database."""

    spark: SparkSession
    database: str = "default"

    def path(self, name: str) -> str:
        return f"{self.database}.{name}"

    def table(self, name: str) -> DataFrame:
        return self.spark.table(self.path(name))


def query_tables(spark: SparkSession, sql: str, **tables: DataFrame) -> DataFrame:
    """Result of a SQL text over frames, each written as ``{name}`` in the text."""
    return spark.sql(sql, **tables)


@dataclass(frozen=True)
class LoadZone:
    """Raw tables in load folders, of which readers see complete ones only.

    A load writes its tables below ``<root>/_loads/<id>`` and is then entered in the log
    ``<root>/_loaded``. A table is read from the last entered load that has it, so a load that
    fails half way, or one that lacks a file, leaves the tables before it in place.
    """

    spark: SparkSession
    root: str

    def folder(self, load_id: str) -> ParquetZone:
        return ParquetZone(self.spark, f"{self.root.rstrip('/')}/_loads/{load_id}")

    def _log(self) -> str:
        return f"{self.root.rstrip('/')}/_loaded"

    def exists(self) -> bool:
        return path_exists(self.spark, self._log())

    def enter(self, load_id: str, tables: Iterable[str]) -> None:
        """Make the tables of a complete load the ones that readers see."""
        entry = self.spark.createDataFrame(
            [(load_id, sorted(tables))], "load_id string, tables array<string>"
        ).withColumn("loaded_at", F.current_timestamp())
        entry.write.mode("append").parquet(self._log())

    def entered(self) -> dict[str, list[str]]:
        """Complete loads with the tables of each."""
        if not self.exists():
            return {}
        rows = self.spark.read.parquet(self._log()).select("load_id", "tables").collect()
        return {row["load_id"]: row["tables"] for row in rows}

    def table(self, name: str) -> DataFrame:
        loads = self.spark.read.parquet(self._log()).filter(F.array_contains("tables", name))
        last = loads.orderBy(F.desc("loaded_at"), F.desc("load_id")).first()
        if last is None:
            raise LookupError(f"no load under {self.root} has {name}")
        return self.folder(last["load_id"]).table(name)


@dataclass(frozen=True)
class JdbcZone:
    """Tables of a database reached over JDBC.

    User, password and driver come from ``properties`` or from the environment variables
    TRADEWIND_JDBC_USER and TRADEWIND_JDBC_PASSWORD, never from code.

    A PostgreSQL table is read in ranges of storage blocks, as many as its size needs at
    ``blocks_per_task`` blocks each; each partition of a partitioned table by its own. A table of
    another database is cut at quantiles of its key (``keys``), ``rows_per_task`` rows each;
    of one key value all rows stay together, and without a known key one task reads it.
    ``partitions`` sets another number for a table. ``split_by`` names the key to divide a PostgreSQL
    view by, which has no blocks, into its ``partitions`` or ``view_partitions`` parts.
    ``write_partitions`` bounds the connections that one table is written through.

    The parts of a table are read by connections of their own. Rows that change meanwhile are read
    as of one moment, each exactly once, only from the zone that :meth:`frozen` gives, and only
    where the database can share a snapshot (PostgreSQL). Else a row that moves meanwhile
    may be read twice or not at all.
    """

    spark: SparkSession
    url: str
    properties: Mapping[str, str] = field(default_factory=dict)
    split_by: Mapping[str, str] = field(default_factory=dict)
    partitions: Mapping[str, int] = field(default_factory=dict)
    keys: Mapping[str, str] = field(default_factory=lambda: dict(RAW_KEYS))
    blocks_per_task: int = 16_384
    rows_per_task: int = 1_000_000
    view_partitions: int = 32
    fetch_size: int = 10_000
    batch_size: int = 1_000
    write_partitions: int = 16
    snapshot: str | None = None

    @property
    def dialect(self) -> Dialect:
        return dialect_of(self.url)

    def _secrets(self) -> dict[str, str]:
        found = {
            "user": os.environ.get("TRADEWIND_JDBC_USER"),
            "password": os.environ.get("TRADEWIND_JDBC_PASSWORD"),
        }
        return {k: v for k, v in found.items() if v} | dict(self.properties)

    def read_properties(self) -> dict[str, str]:
        start = {}
        if self.snapshot is not None:
            # Runs first on every connection, within the transaction that it reads in.
            start["sessionInitStatement"] = self.dialect.snapshot_join(self.snapshot)
        return {"fetchsize": str(self.fetch_size)} | start | self._secrets()

    def write_properties(self) -> dict[str, str]:
        sizes = {"batchsize": self.batch_size, "numPartitions": self.write_partitions}
        return {name: str(size) for name, size in sizes.items()} | self._secrets()

    def connection(self):
        """A connection of the driver's own, for statements that Spark's reader cannot run."""
        jvm = self.spark._jvm
        secrets = self._secrets()
        settings = jvm.java.util.Properties()
        for name in ("user", "password"):
            if name in secrets:
                settings.setProperty(name, secrets[name])
        if "driver" in secrets:
            # A driver from --jars is known to the thread's class loader only.
            loader = jvm.java.lang.Thread.currentThread().getContextClassLoader()
            driver = loader.loadClass(secrets["driver"]).getConstructor([]).newInstance([])
            return driver.connect(self.url, settings)
        return jvm.java.sql.DriverManager.getConnection(self.url, settings)

    @contextmanager
    def frozen(self, *names: str) -> Iterator[JdbcZone]:
        """The zone as of one moment. Tables must be read and stored before the context ends.

        One connection of the driver holds the snapshot, which all read tasks join, and keeps the
        named tables from being rewritten. A database without shared snapshots gives the zone
        itself, with a warning.
        """
        dialect = self.dialect
        if not dialect.snapshot_begin:
            log.warning("%s: no shared snapshot, tables are read while they change", self.url)
            yield self
            return
        connection = self.connection()
        try:
            connection.setAutoCommit(False)
            statement = connection.createStatement()
            *begin, export = dialect.snapshot_begin
            for sql in begin:
                statement.execute(sql)
            result = statement.executeQuery(export)
            result.next()
            snapshot = result.getString(1)
            for name in names:
                statement.execute(dialect.pin_sql(name))
            yield replace(self, snapshot=snapshot)
        finally:
            connection.rollback()
            connection.close()

    def leaves(self, name: str) -> list[tuple[str, int]]:
        """The PostgreSQL tables that hold a table's rows, with their storage blocks."""
        rows = self.query(self.dialect.leaves_sql(name)).collect()
        return [(row["part"], int(row["blocks"])) for row in rows]

    def parts(self, name: str) -> dict[str, list[str]]:
        """The tables to read for a table, each with one condition per read task."""
        if not isinstance(self.dialect, PostgreSQL):
            return {name: self._key_parts(name)}
        if name in self.split_by:
            tasks = self.partitions.get(name, self.view_partitions)
            return {name: hash_predicates(self.split_by[name], tasks)}
        leaves = self.leaves(name)
        total = max(1, sum(blocks for _, blocks in leaves))
        tasks = self.partitions.get(name, -(-total // self.blocks_per_task))
        each = -(-total // max(1, tasks))
        return {part: block_ranges(blocks, -(-blocks // each)) for part, blocks in leaves}

    def _key_parts(self, name: str) -> list[str]:
        key = self.split_by.get(name, self.keys.get(name))
        if key is None:
            log.warning("%s has no known key: one task reads it", name)
            return key_ranges("", [])
        rows = int(self.query(self.dialect.count_sql(name)).first()["n"])
        tasks = self.partitions.get(name, -(-rows // self.rows_per_task))
        if tasks < 2:
            return key_ranges(key, [])
        lows = self.query(self.dialect.quantiles_sql(name, key, tasks, rows)).collect()
        return key_ranges(key, [row["low"] for row in lows[1:]])

    def table(self, name: str) -> DataFrame:
        frames = [
            self.spark.read.jdbc(
                self.url, part, predicates=conditions, properties=self.read_properties()
            )
            for part, conditions in self.parts(name).items()
        ]
        return reduce(DataFrame.unionByName, frames)

    def query(self, sql: str) -> DataFrame:
        """Result of a statement that the database runs itself."""
        options = {"url": self.url, "query": sql} | self.read_properties()
        return self.spark.read.format("jdbc").options(**options).load()

    def stage(self, df: DataFrame, name: str) -> str:
        """Write a table beside the one it is to replace; its name."""
        staged = f"{name}__new"
        df.write.jdbc(self.url, staged, mode="overwrite", properties=self.write_properties())
        return staged

    def swap(self, tables: Mapping[str, str]) -> None:
        """Put staged tables in place of others, ``{staged: final}``, all seen at once."""
        connection = self.connection()
        try:
            connection.setAutoCommit(False)
            statement = connection.createStatement()
            for sql in self.dialect.swap_sql(tables):
                statement.execute(sql)
            connection.commit()
        except BaseException:
            connection.rollback()
            raise
        finally:
            connection.close()

    def can_swap(self) -> bool:
        return self.dialect.swap_sql({}) is not None

    def replace(self, df: DataFrame, name: str) -> None:
        """Replace a table. Readers see the old one until the new one is complete.

        In a database whose dialect knows no swap the table is dropped, created and filled,
        with a warning. Views and grants on the old table are not carried over.
        """
        if self.can_swap():
            self.swap({self.stage(df, name): name})
            return
        log.warning("%s: no swap known, readers of %s see it empty meanwhile", self.url, name)
        df.write.jdbc(self.url, name, mode="overwrite", properties=self.write_properties())
