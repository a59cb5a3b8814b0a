"""The star schema: one fact and three dimensions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.operators.aggregates import keep_first, row_order, timestamp_bounds
from tradewind.operators.calendar import calendar, date_spine
from tradewind.operators.clean import with_revenue
from tradewind.operators.joins import lookup_join
from tradewind.schemas import ORDINAL, WAREHOUSE_COLUMNS

FACT_MONEY = ("price", "freight_value", "revenue")
# The folder column of a fact stored by month.
MONTH = "order_month"


def item_lines(items: DataFrame, orders: DataFrame, products: DataFrame) -> DataFrame:
    """Every item with its delivered order and its category, money as decimal.

    Items of other orders stay, with a null customer, date and status.
    """
    header = orders.select("order_id", "customer_id", "order_date", "order_status")
    lines = lookup_join(items, header, "order_id")
    lines = lookup_join(lines, products.select("product_id", "category_english"), "product_id")
    return with_revenue(lines).select(*WAREHOUSE_COLUMNS["fact_order_items"])


def delivered_money(lines: DataFrame) -> DataFrame:
    """Item lines with money as double, as the fact delivers it."""
    return lines.withColumns({name: F.col(name).cast("double") for name in FACT_MONEY})


def fact_order_items(items: DataFrame, orders: DataFrame, products: DataFrame) -> DataFrame:
    """The fact table."""
    return delivered_money(item_lines(items, orders, products))


def month_number(date: Column) -> Column:
    """A date's year and month as one number, such as 201711."""
    return (F.year(date) * 100 + F.month(date)).cast("int")


def clustered_by_month(fact: DataFrame) -> DataFrame:
    """The fact with its month, dealt out and sorted by it, for a table in monthly folders.

    Ranges of day and order are of equal size whatever a month or day holds, so a hot day is
    several tasks and every task writes few files. Items without a delivered order have no
    month and a folder of their own.
    """
    order = (MONTH, "order_date", "order_id")
    months = fact.withColumn(MONTH, month_number(F.col("order_date")))
    return months.repartitionByRange(*order).sortWithinPartitions(*order)


def fact_on_days(fact: DataFrame, days: DataFrame) -> DataFrame:
    """Fact rows of the given days, with the other columns of these rows of ``dim_date``.

    ``fact`` is in monthly folders. Days are joined by month as well: once they are known at run
    time, folders of other months are not read.
    """
    keyed_days = days.withColumn(MONTH, month_number(F.col("date")))
    return fact.join(keyed_days.withColumnRenamed("date", "order_date"), [MONTH, "order_date"])


def dim_customers(customers: DataFrame) -> DataFrame:
    """First customer record per unique customer."""
    ordered = [c for c in customers.columns if c == ORDINAL]
    narrow = customers.select(*WAREHOUSE_COLUMNS["dim_customers"], *ordered)
    return keep_first(narrow, "customer_unique_id", row_order(narrow, "customer_id"))


def dim_products(products: DataFrame) -> DataFrame:
    """First category per product."""
    ordered = [c for c in products.columns if c == ORDINAL]
    narrow = products.select(*WAREHOUSE_COLUMNS["dim_products"], *ordered)
    return keep_first(narrow, "product_id", row_order(narrow, "category_english"))


def dim_date(orders: DataFrame) -> DataFrame:
    """Calendar between the first and last delivered purchase."""
    return calendar(date_spine(timestamp_bounds(orders)))
