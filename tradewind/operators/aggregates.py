"""Grouped aggregates. All merge partial results before the shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.functions.numbers import sum_or_zero
from tradewind.operators.clean import keyed
from tradewind.schemas import ORDINAL


def row_order(df: DataFrame, *business_key: str) -> Column:
    """The source row order where it was recorded.

    Elsewhere the given columns and then all others by name, nulls last, so that only rows
    equal in every column tie.
    """
    if ORDINAL in df.columns:
        return F.struct(ORDINAL)
    others = sorted(name for name in df.columns if name not in business_key)
    return F.struct(
        *(part for name in (*business_key, *others) for part in (F.col(name).isNull(), F.col(name)))
    )


def first_present(value: str, order: Column) -> Column:
    """First non-null value in row order."""
    return F.min_by(F.col(value), F.when(F.col(value).isNotNull(), order))


def payments_per_order(payments: DataFrame) -> DataFrame:
    """One row per order: first payment type, most installments, total paid."""
    order = row_order(payments, "payment_installments", "payment_value", "payment_type")
    return (
        keyed(payments, "order_id")
        .groupBy("order_id")
        .agg(
            first_present("payment_type", order).alias("payment_type"),
            F.max("payment_installments").alias("payment_installments"),
            sum_or_zero(F.col("payment_value")).alias("payment_value"),
        )
    )


def keep_first(df: DataFrame, key: str, order: Column) -> DataFrame:
    """First row per key in ``order``; null counts as one key value.

    ``min_by`` is merged map-side, so a key that owns a third of all rows reaches
    the shuffle as one row per task, unlike with a window over the key.
    """
    others = [name for name in df.columns if name not in (key, ORDINAL)]
    first = F.min_by(F.struct(*others), order).alias("_first")
    columns = [F.col(key) if name == key else F.col(f"_first.{name}") for name in df.columns
               if name != ORDINAL]
    return df.groupBy(key).agg(first).select(*columns)


def timestamp_bounds(orders: DataFrame, column: str = "order_purchase_timestamp") -> DataFrame:
    """One row with the earliest and latest timestamp."""
    return orders.agg(F.min(column).alias("min_ts"), F.max(column).alias("max_ts"))
