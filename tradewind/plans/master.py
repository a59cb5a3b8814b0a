"""The wide item-level table."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tradewind.operators.aggregates import payments_per_order
from tradewind.operators.clean import with_revenue
from tradewind.operators.joins import fan_out_join, lookup_join
from tradewind.schemas import ORDINAL


def master(
    orders: DataFrame,
    customers: DataFrame,
    items: DataFrame,
    products: DataFrame,
    payments: DataFrame,
) -> DataFrame:
    """Delivered orders with customer, items, product and payment, one row per item.

    Payments are joined while rows are still orders, so the item rows cross the
    network once for ``order_id`` and once for ``product_id``. The payment total of
    an order repeats on each of its items.
    """
    per_order = lookup_join(orders, payments_per_order(payments), "order_id")
    per_order = lookup_join(per_order, customers.drop(ORDINAL), "customer_id")
    lines = fan_out_join(per_order, items.drop(ORDINAL), "order_id")
    lines = lookup_join(lines, products.drop(ORDINAL), "product_id")
    return with_revenue(lines)
