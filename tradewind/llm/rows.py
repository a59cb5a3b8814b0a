"""Row identity, stored intermediate tables and row multiplication."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, VariantType

from tradewind.session import drop_scratch, scratch_dir

KEYS = ("__row_a", "__row_b")


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """The table written to the cluster's shared folder and read back.

    It cuts the lineage: a lost executor costs a re-read, not a recomputation.
    """
    folder = f"{scratch_dir(df.sparkSession, purpose)}/table"
    df.write.option("compression", "zstd").parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def discard(df: DataFrame) -> None:
    """Remove a table of :func:`stored` that no later plan reads."""
    for folder in {path.rsplit("/", 1)[0] for path in df.inputFiles()}:
        drop_scratch(df.sparkSession, folder)


def hash_pair(*columns: Column) -> tuple[Column, Column]:
    """128 bits from two independently seeded 64-bit hashes; nulls count as values."""
    parts = [part for c in columns for part in (c, c.isNull())]
    return F.xxhash64(*parts), F.xxhash64(F.lit(1), *parts)


def with_row_key(df: DataFrame) -> DataFrame:
    """Adds the two key columns that identify a row by the content of all its columns.

    Rows that agree in every column share a key; they are interchangeable.
    """
    columns = [
        F.to_json(F.struct(df[f"`{f.name}`"]))
        if isinstance(f.dataType, (MapType, VariantType))
        else df[f"`{f.name}`"]
        for f in df.schema
    ]
    return df.withColumns(dict(zip(KEYS, hash_pair(*columns), strict=True)))


def multiplied(docs: DataFrame, counts: DataFrame) -> DataFrame:
    """Each class of equal rows ``__copies`` times, numbered by ``__copy`` from 0.

    ``docs`` comes from :func:`with_row_key`. ``counts`` has one row per class: the keys,
    ``__rows`` (rows of the class in ``docs``), ``__copies`` and any further columns, which
    the result carries. Classes it does not name go. Classes of one row, nearly all, pass
    straight through the join; larger ones are first reduced to one row, map-side.
    """
    wanted = counts.filter("__copies > 0")
    joined = docs.join(wanted, list(KEYS))
    others = [c for c in joined.columns if c not in KEYS]
    single = joined.filter("__rows = 1").select(*KEYS, *[f"`{c}`" for c in others])
    several = (
        joined.filter("__rows > 1")
        .groupBy(*KEYS)
        .agg(F.first(F.struct(*[F.col(f"`{c}`") for c in others])).alias("__row"))
        .select(*KEYS, *[F.col("__row").getField(c).alias(c) for c in others])
    )
    return single.unionByName(several).withColumn(
        "__copy", F.explode(F.sequence(F.lit(0), F.col("__copies").cast("int") - 1))
    )
