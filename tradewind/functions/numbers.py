"""Rounding and aggregate expressions for money and counts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_even(value: Column, digits: int) -> Column:
    """Round the double ``value`` to ``digits`` decimals, ties to the even neighbour."""
    scale = float(10**digits)
    return F.rint(value.cast("double") * scale) / scale


def sum_or_zero(value: Column) -> Column:
    """Sum that is 0, not null, for a group without any value."""
    return F.coalesce(F.sum(value), F.lit(0))


def ratio(total: Column, count: Column) -> Column:
    """Exact total over count as a double; null where nothing was counted."""
    return F.try_divide(total.cast("double"), count)


def mean(value: Column) -> Column:
    """Mean of the non-null values, divided once from the exact sum."""
    return ratio(F.sum(value), F.count(value))


def line_revenue() -> Column:
    """Price plus freight of one item; null when either is missing."""
    return F.col("price") + F.col("freight_value")
