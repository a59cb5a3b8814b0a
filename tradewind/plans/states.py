"""Order totals as states that merge, so that a refresh reads new rows only.

The state of an order is what its totals are made of: sums and counts over its items and payments, which
add up, and its latest header. States of old and new rows merge to the state of all rows,
whatever came first: items before their order, payments long after it, an order again
with another status.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.functions.numbers import line_revenue
from tradewind.operators.clean import coerce_timestamps, keyed, only_status, with_order_date

HEADER = (
    "customer_id", "order_status", "order_purchase_timestamp", "order_delivered_customer_date",
)
SUM = "decimal(38,4)"


def order_states(
    load_id: str, orders: DataFrame, items: DataFrame, payments: DataFrame
) -> DataFrame:
    """The states of a load's rows, not merged yet.

    Loads sort by their ids; of an order's headers that of the last load counts. An order
    comes once in a load.
    """
    typed = coerce_timestamps(orders, HEADER[2:])
    header = F.struct(F.lit(load_id).alias("load"), *HEADER)
    one = F.lit(1).cast("long")
    # What a table does not know of an order.
    nothing = {
        "line_count": F.lit(0).cast("long"),
        "item_count": F.lit(0).cast("long"),
        "revenue": F.lit(None).cast(SUM),
        "payments": F.lit(0).cast("long"),
        "payment_value": F.lit(None).cast(SUM),
        "header": F.lit(None).cast(typed.select(header.alias("header")).schema["header"].dataType),
    }

    def states(df: DataFrame, **known: Column) -> DataFrame:
        columns = [known.get(name, value).alias(name) for name, value in nothing.items()]
        return keyed(df, "order_id").select("order_id", *columns)

    return reduce(
        DataFrame.unionByName,
        (
            states(typed, header=header),
            states(
                items,
                line_count=one,
                item_count=F.col("order_item_id").isNotNull().cast("long"),
                revenue=line_revenue().cast(SUM),
            ),
            states(payments, payments=one, payment_value=F.col("payment_value").cast(SUM)),
        ),
    )


def merged(*states: DataFrame) -> DataFrame:
    """One state per order. Merged map-side first, so a hot order is one row per task."""
    names = ("line_count", "item_count", "revenue", "payments", "payment_value")
    return (
        reduce(DataFrame.unionByName, states)
        .groupBy("order_id")
        .agg(
            *[F.sum(name).alias(name) for name in names],
            # Null headers of items and payments are below any other.
            F.max("header").alias("header"),
        )
        .withColumns({name: F.col(name).cast(SUM) for name in ("revenue", "payment_value")})
    )


def totals_of(states: DataFrame) -> DataFrame:
    """As :func:`tradewind.plans.rollups.order_totals`, from merged states."""
    flat = states.filter("header IS NOT NULL").select("*", *[f"header.{name}" for name in HEADER])
    delivered = flat.transform(only_status).transform(with_order_date)
    has_items, has_payments = F.col("line_count") > 0, F.col("payments") > 0
    paid = F.coalesce("payment_value", F.lit(0).cast(SUM))
    return delivered.select(
        "order_id",
        "customer_id",
        "order_date",
        "order_purchase_timestamp",
        "order_delivered_customer_date",
        F.when(has_items, F.col("line_count")).otherwise(1).alias("line_count"),
        "item_count",
        F.when(has_items, F.col("revenue")).cast("decimal(29,4)").alias("revenue"),
        F.when(has_payments, paid).cast("decimal(28,4)").alias("payment_value"),
    )
