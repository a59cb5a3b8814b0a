"""Global positions in a sorted table, without a window over all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradewind.llm.rows import stored


def ranked(df: DataFrame, *order: Column, name: str = "__rank") -> DataFrame:
    """``df`` with its position in the given order, from 0 without gaps.

    Rows are dealt out by range and sorted within partitions; the position in the table is the
    number of rows of all earlier partitions plus the place within. Only one count per
    partition is added up. Rows that tie in the whole order take arbitrary places.
    """
    dealt = df.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = stored(dealt.withColumn("__id", F.monotonically_increasing_id()), "ranked")
    part, place = F.shiftrightunsigned("__id", 33), F.col("__id").bitwiseAND((1 << 33) - 1)
    numbered = placed.withColumns({"__part": part, "__place": place})
    # One row per partition.
    running = Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    offsets = stored(
        numbered.groupBy(F.col("__part").alias("__p"))
        .count()
        .select("__p", (F.sum("count").over(running) - F.col("count")).alias("__before")),
        "offsets",
    )
    return (
        numbered.join(offsets, F.col("__part") == F.col("__p"))
        .withColumn(name, F.col("__before") + F.col("__place"))
        .drop("__id", "__part", "__place", "__p", "__before")
    )
