"""The four aggregate marts from item-level or order-level rows.

These hold for any input, duplicate keys included. ``plans.rollups`` has the
cheaper forms for inputs whose keys are known to be unique.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.functions.numbers import mean, ratio, round_half_even, sum_or_zero
from tradewind.operators.clean import keyed, with_delivery_days
from tradewind.operators.joins import lookup_join

PRODUCT_KEYS = ("product_id", "category_english")
CUSTOMER_KEYS = ("customer_unique_id", "customer_city", "customer_state")

# Decimals that the measures of each mart are rounded to.
ROUNDING = {
    "daily_revenue": {"total_revenue": 2, "avg_order_value": 2},
    "top_products": {"total_revenue": 2, "avg_price": 2},
    "customer_summary": {"total_spent": 2},
    "delivery_performance": {"avg_delivery_days": 1},
}


def rounded(table: str, df: DataFrame) -> DataFrame:
    """Round a mart's measures for delivery."""
    return df.withColumns(
        {name: round_half_even(F.col(name), digits) for name, digits in ROUNDING[table].items()}
    )


def by_date(master: DataFrame) -> DataFrame:
    """Orders, items, revenue and mean order value by purchase date.

    The mean weighs an order's payment total by its number of item rows.
    """
    return (
        keyed(master, "order_date")
        .groupBy("order_date")
        .agg(
            F.count_distinct("order_id").alias("total_orders"),
            F.count("order_item_id").alias("total_items"),
            sum_or_zero(F.col("revenue")).cast("double").alias("total_revenue"),
            mean(F.col("payment_value")).alias("avg_order_value"),
        )
    )


def by_product(lines: DataFrame) -> DataFrame:
    """Items sold, revenue and mean price by product and category.

    ``lines`` is the master table, or the fact rows of delivered orders.
    """
    return (
        keyed(lines, *PRODUCT_KEYS)
        .groupBy(*PRODUCT_KEYS)
        .agg(
            F.count("order_item_id").alias("total_items_sold"),
            sum_or_zero(F.col("revenue")).cast("double").alias("total_revenue"),
            mean(F.col("price")).alias("avg_price"),
        )
    )


def by_customer(master: DataFrame) -> DataFrame:
    """Orders, spending, first and last order by customer and place.

    An order's payment total counts once per item row, and a customer who moved
    has one row per place.
    """
    return (
        keyed(master, *CUSTOMER_KEYS)
        .groupBy(*CUSTOMER_KEYS)
        .agg(
            F.count_distinct("order_id").alias("total_orders"),
            sum_or_zero(F.col("payment_value")).cast("double").alias("total_spent"),
            F.min("order_date").alias("first_order"),
            F.max("order_date").alias("last_order"),
        )
    )


def by_state(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Delivery days by customer state.

    Orders are summed per customer first: every measure is additive over the join,
    and a customer with very many orders reaches it as one row.
    """
    per_customer = (
        keyed(with_delivery_days(orders), "customer_id")
        .groupBy("customer_id")
        .agg(
            F.count("order_id").alias("orders"),
            F.sum("delivery_days").alias("days"),
            F.count("delivery_days").alias("delivered"),
            F.min("delivery_days").alias("fastest"),
            F.max("delivery_days").alias("slowest"),
        )
    )
    placed = lookup_join(
        per_customer, customers.select("customer_id", "customer_state"), "customer_id"
    )
    avg_days = ratio(F.sum("days"), F.sum("delivered"))
    return (
        keyed(placed, "customer_state")
        .groupBy("customer_state")
        .agg(
            F.sum("orders").alias("total_orders"),
            avg_days.alias("avg_delivery_days"),
            F.min("fastest").alias("min_delivery_days"),
            F.max("slowest").alias("max_delivery_days"),
        )
    )


def daily_revenue(master: DataFrame) -> DataFrame:
    """Mart of :func:`by_date`."""
    return rounded("daily_revenue", by_date(master))


def top_products(lines: DataFrame) -> DataFrame:
    """Mart of :func:`by_product`."""
    return rounded("top_products", by_product(lines))


def customer_summary(master: DataFrame) -> DataFrame:
    """Mart of :func:`by_customer`."""
    return rounded("customer_summary", by_customer(master))


def delivery_performance(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Mart of :func:`by_state`."""
    return rounded("delivery_performance", by_state(orders, customers))
