"""Date and timestamp expressions, independent of the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tradewind.schemas import TIMESTAMP_FORMAT

# Exactly the characters of TIMESTAMP_FORMAT; the cast alone would also take a bare
# date, a "T" separator or fractions of a second.
_TIMESTAMP_SHAPE = "^[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}$"


def strict_timestamp(text: Column, fmt: str = TIMESTAMP_FORMAT) -> Column:
    """Text to ``timestamp_ntz``; null for anything not written in ``fmt``."""
    if fmt == TIMESTAMP_FORMAT:
        # Half the time of a formatter-based parse, same result.
        return F.when(text.rlike(_TIMESTAMP_SHAPE), text.try_cast("timestamp_ntz"))
    return F.try_to_timestamp(text, F.lit(fmt)).cast("timestamp_ntz")


def elapsed_days(start: Column, end: Column) -> Column:
    """Whole 24-hour periods from ``start`` to ``end``, floored also when negative.

    The calendar distance is one too many when adding that many days to ``start``
    overshoots ``end``.
    """
    calendar_days = F.datediff(end, start)
    overshoots = start + F.make_dt_interval(calendar_days) > end
    return (calendar_days - overshoots.cast("int")).cast("bigint")


def calendar_columns(day: Column) -> dict[str, Column]:
    """Attributes of a calendar day, in the column order of ``dim_date``."""
    weekday = F.weekday(day)  # Monday is 0
    return {
        "date": day,
        "day": F.dayofmonth(day),
        "month": F.month(day),
        "month_name": F.date_format(day, "MMMM"),
        "quarter": F.quarter(day),
        "year": F.year(day),
        "day_of_week": weekday,
        "day_name": F.date_format(day, "EEEE"),
        "is_weekend": weekday >= 5,
    }
