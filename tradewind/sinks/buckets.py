"""Raw tables laid out by join key, so that joins on it need no shuffle.

The tables that meet on a key are written in the same number of buckets of its hash. A join or
a grouping by the key then reads one bucket of each table per task. Nothing divides a
bucket at run time as AQE divides a shuffled partition, so tables are laid out like this only
where no key is hot.
"""

from __future__ import annotations

import logging
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.session import TARGET_PARTITION_BYTES, estimated_bytes, in_parallel
from tradewind.sinks.tables import counted, rows_of
from tradewind.sources.tables import CatalogZone

log = logging.getLogger(__name__)

# The tables that are joined and grouped by an order's key.
ORDER_TABLES = ("raw_orders", "raw_order_items", "raw_order_payments")
# A key is hot if it alone makes its bucket this many times the mean.
HOT_FACTOR = 4


def buckets_of(size: int) -> int:
    """Buckets of at most 128 MB that ``size`` bytes need, as a power of two.

    Powers of two divide each other, so tables laid out at different times can still meet: Spark
    reads the buckets that fall together as one.
    """
    needed = max(1, -(-size // TARGET_PARTITION_BYTES))
    return 1 << (needed - 1).bit_length()


def buckets_for(*tables: DataFrame) -> int:
    """Buckets that keep those of the largest table near 128 MB by Catalyst's estimate."""
    return buckets_of(max(filter(None, map(estimated_bytes, tables)), default=0))


def row_bytes(df: DataFrame) -> int:
    """Bytes of a row that a task sorts, by Catalyst's reckoning of its types."""
    return 8 + df._jdf.schema().defaultSize()


def key_load(df: DataFrame, key: str) -> tuple[int, int]:
    """Rows of the commonest key, null included, and all rows; one map-side combined pass."""
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
    row = per_key.agg(F.max("rows").alias("most"), F.sum("rows").alias("all")).first()
    return row["most"] or 0, row["all"] or 0


def hottest_share(df: DataFrame, key: str) -> float:
    """Share of all rows that the commonest key holds, null included."""
    most, rows = key_load(df, key)
    return most / rows if rows else 0.0


@dataclass(frozen=True)
class BucketSink:
    """Catalog tables of which some are laid out by a key in ``buckets`` buckets."""

    zone: CatalogZone
    keys: Mapping[str, str]
    buckets: int

    def write(self, df: DataFrame, name: str) -> int:
        df, observation = counted(df)
        key = self.keys.get(name)
        if key is None:
            df.write.format("parquet").mode("overwrite").saveAsTable(self.zone.path(name))
        else:
            # Dealt out as the buckets are, so every task writes one file of one bucket.
            writer = df.repartition(self.buckets, key).write.format("parquet")
            writer = writer.bucketBy(self.buckets, key).sortBy(key).mode("overwrite")
            writer.saveAsTable(self.zone.path(name))
        return rows_of(observation)


def lay_out(
    spark: SparkSession,
    tables: Mapping[str, DataFrame],
    database: str,
    *,
    key: str = "order_id",
    by_key: tuple[str, ...] = ORDER_TABLES,
    buckets: int | None = None,
    least: int = 1,
    threads: int = 4,
) -> dict[str, int]:
    """Store raw tables in a catalog database, those named in ``by_key`` in buckets of ``key``.

    Row counts by table. With a hot key in one of them all are stored plainly, with a warning:
    shuffled joins divide a hot key at run time, and a table in buckets would keep its partner's rows
    together.

    The number of buckets grows with the largest of these tables, by its files or its counted rows,
    whichever asks for more: files say little where values compress well, and nothing for JDBC. It
    is ``least`` or more; ``buckets`` sets another number than the sizes call for.
    """
    present = [name for name in by_key if name in tables]
    loads = {}
    if buckets != 1:
        counts = in_parallel(spark, [lambda n=n: key_load(tables[n], key) for n in present], threads)
        loads = dict(zip(present, counts, strict=True))
    counted_bytes = [rows * row_bytes(tables[n]) for n, (_, rows) in loads.items()]
    number = buckets or max(
        least, buckets_for(*[tables[n] for n in present]), buckets_of(max(counted_bytes, default=0))
    )
    hot = [n for n, (most, rows) in loads.items() if most * number > HOT_FACTOR * rows]
    if hot:
        log.warning("hot %s in %s: tables are stored without buckets", key, ", ".join(hot))
    sink = BucketSink(CatalogZone(spark, database), {} if hot else dict.fromkeys(present, key), number)
    jobs = [lambda n=n, df=df: sink.write(df, n) for n, df in tables.items()]
    return dict(zip(tables, in_parallel(spark, jobs, threads), strict=True))
