"""Daily date spine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.functions.dates import calendar_columns


def date_spine(bounds: DataFrame) -> DataFrame:
    """One row per step of a day from ``min_ts`` while not past ``max_ts``.

    Stepping over timestamps keeps the start's time of day, so the last calendar
    day is missing when the latest time of day is before the earliest one's. The
    row count is bounded by the calendar, not by the data; no bounds, no rows.
    """
    steps = F.sequence("min_ts", "max_ts", F.expr("interval 1 day"))
    return bounds.select(F.explode(steps).alias("step")).select(F.to_date("step").alias("date"))


def calendar(spine: DataFrame) -> DataFrame:
    """Calendar attributes of every day of a spine."""
    columns = calendar_columns(F.col("date"))
    return spine.select(*(column.alias(name) for name, column in columns.items()))
