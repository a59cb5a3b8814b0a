"""Cleaning orders and deriving columns."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewind.functions.dates import elapsed_days, strict_timestamp
from tradewind.functions.numbers import line_revenue
from tradewind.schemas import DELIVERED, ORDER_TIMESTAMPS, TIMESTAMP_FORMAT


def coerce_timestamps(
    df: DataFrame, columns: Sequence[str] = ORDER_TIMESTAMPS, fmt: str = TIMESTAMP_FORMAT
) -> DataFrame:
    """Parse text columns to ``timestamp_ntz``, unreadable text to null.

    Columns that already hold timestamps (parquet, JDBC) are only converted.
    """
    parsed = {}
    for name in columns:
        is_text = isinstance(df.schema[name].dataType, T.StringType)
        column = F.col(name)
        parsed[name] = strict_timestamp(column, fmt) if is_text else column.cast("timestamp_ntz")
    return df.withColumns(parsed)


def only_status(orders: DataFrame, status: str = DELIVERED) -> DataFrame:
    """Orders in one status; a null status never qualifies."""
    return orders.filter(F.col("order_status") == status)


def with_order_date(orders: DataFrame) -> DataFrame:
    """Add the calendar date of the purchase."""
    return orders.withColumn("order_date", F.to_date("order_purchase_timestamp"))


def clean_orders(raw_orders: DataFrame) -> DataFrame:
    """Delivered orders with typed timestamps and ``order_date``."""
    return raw_orders.transform(only_status).transform(coerce_timestamps).transform(with_order_date)


def with_revenue(items: DataFrame) -> DataFrame:
    """Add ``revenue`` = price + freight."""
    return items.withColumn("revenue", line_revenue())


def with_delivery_days(orders: DataFrame) -> DataFrame:
    """Add whole days from purchase to delivery."""
    days = elapsed_days(F.col("order_purchase_timestamp"), F.col("order_delivered_customer_date"))
    return orders.withColumn("delivery_days", days)


def keyed(df: DataFrame, *keys: str) -> DataFrame:
    """Rows whose keys are all present; grouped results hold no null keys.

    Plain ``IS NOT NULL`` conditions reach the parquet scan and turn outer joins
    below into inner ones, which ``dropna`` does not.
    """
    return df.filter(reduce(and_, (F.col(key).isNotNull() for key in keys)))
