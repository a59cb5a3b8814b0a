"""The marts without the item-level join.

The master table repeats every order on each of its items and then sums. The same
numbers come from one row per order that carries its item count: items and
payments are each reduced map-side by ``order_id`` (so a hot order is one row per
task), and neither the wide table nor the product join is needed. Money stays
decimal until the last step, so regrouping the sums changes no digit. Which keys
have to be unique for each mart is in ``plans.warehouse.NEEDS``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.functions.numbers import line_revenue, ratio, sum_or_zero
from tradewind.operators.clean import keyed
from tradewind.operators.joins import lookup_join
from tradewind.plans.marts import CUSTOMER_KEYS, PRODUCT_KEYS, rounded


def order_totals(orders: DataFrame, items: DataFrame, payments: DataFrame) -> DataFrame:
    """One row per delivered order: its times, item totals and payment total.

    ``line_count`` is the number of master rows of the order, 1 without items. The
    result also serves as the ``orders`` of delivery_performance and dim_date.
    """
    per_order_items = (
        keyed(items, "order_id")
        .groupBy("order_id")
        .agg(
            F.count(F.lit(1)).alias("line_count"),
            F.count("order_item_id").alias("item_count"),
            F.sum(line_revenue()).alias("revenue"),
        )
    )
    per_order_payments = (
        keyed(payments, "order_id")
        .groupBy("order_id")
        .agg(sum_or_zero(F.col("payment_value")).alias("payment_value"))
    )
    header = orders.select(
        "order_id", "customer_id", "order_date",
        "order_purchase_timestamp", "order_delivered_customer_date",
    )
    totals = lookup_join(header, per_order_items, "order_id")
    totals = lookup_join(totals, per_order_payments, "order_id")
    return totals.withColumns(
        {
            "line_count": F.coalesce("line_count", F.lit(1)),
            "item_count": F.coalesce("item_count", F.lit(0)),
        }
    )


def daily_revenue(totals: DataFrame) -> DataFrame:
    """As :func:`tradewind.plans.marts.daily_revenue`, from order totals.

    Rows of one order and day are merged first, which counts a repeated order once. They lie
    together already, since the totals are dealt out by order.
    """
    paid_lines = F.when(F.col("payment_value").isNotNull(), F.col("line_count"))
    per_order = (
        keyed(totals, "order_date")
        .groupBy("order_id", "order_date")
        .agg(
            F.sum("item_count").alias("items"),
            F.sum("revenue").alias("revenue"),
            F.sum(F.col("payment_value") * F.col("line_count")).alias("paid"),
            F.sum(paid_lines).alias("paid_lines"),
        )
    )
    summed = per_order.groupBy("order_date").agg(
        F.count("order_id").alias("total_orders"),
        F.sum("items").alias("total_items"),
        sum_or_zero(F.col("revenue")).cast("double").alias("total_revenue"),
        ratio(F.sum("paid"), F.sum("paid_lines")).alias("avg_order_value"),
    )
    return rounded("daily_revenue", summed)


def customer_summary(totals: DataFrame, customers: DataFrame) -> DataFrame:
    """As :func:`tradewind.plans.marts.customer_summary`, from order totals.

    Orders are summed per ``customer_id`` before they meet the customers.
    """
    per_customer = (
        keyed(totals, "customer_id")
        .groupBy("customer_id")
        .agg(
            F.count("order_id").alias("orders"),
            F.sum(F.col("payment_value") * F.col("line_count")).alias("spent"),
            F.min("order_date").alias("first"),
            F.max("order_date").alias("last"),
        )
    )
    placed = lookup_join(
        per_customer, customers.select("customer_id", *CUSTOMER_KEYS), "customer_id"
    )
    summed = (
        keyed(placed, *CUSTOMER_KEYS)
        .groupBy(*CUSTOMER_KEYS)
        .agg(
            F.sum("orders").alias("total_orders"),
            sum_or_zero(F.col("spent")).cast("double").alias("total_spent"),
            F.min("first").alias("first_order"),
            F.max("last").alias("last_order"),
        )
    )
    return rounded("customer_summary", summed)


def top_products(orders: DataFrame, items: DataFrame, products: DataFrame) -> DataFrame:
    """As :func:`tradewind.plans.marts.top_products`, summed by product before the lookup.

    An item counts as often as its order has rows; a repeated product repeats its sums.
    """
    header = keyed(orders, "order_id").groupBy("order_id").agg(F.count(F.lit(1)).alias("times"))
    sold = keyed(items, "product_id").join(header, "order_id")
    times = F.col("times")
    per_product = sold.groupBy("product_id").agg(
        F.sum(F.when(F.col("order_item_id").isNotNull(), times).otherwise(0)).alias("items"),
        F.sum(line_revenue() * times).alias("revenue"),
        F.sum(F.col("price") * times).alias("price_sum"),
        F.sum(F.when(F.col("price").isNotNull(), times).otherwise(0)).alias("price_count"),
    )
    named = lookup_join(per_product, products.select(*PRODUCT_KEYS), "product_id")
    avg_price = ratio(F.sum("price_sum"), F.sum("price_count"))
    summed = (
        keyed(named, *PRODUCT_KEYS)
        .groupBy(*PRODUCT_KEYS)
        .agg(
            F.sum("items").alias("total_items_sold"),
            sum_or_zero(F.col("revenue")).cast("double").alias("total_revenue"),
            avg_price.alias("avg_price"),
        )
    )
    return rounded("top_products", summed)
