"""Report order of the marts, nulls last, ties broken by the group key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_ORDER = {
    "daily_revenue": lambda: [F.asc_nulls_last("order_date")],
    "top_products": lambda: [
        F.desc_nulls_last("total_revenue"),
        F.asc_nulls_last("product_id"),
        F.asc_nulls_last("category_english"),
    ],
    "customer_summary": lambda: [
        F.desc_nulls_last("total_spent"),
        F.asc_nulls_last("customer_unique_id"),
        F.asc_nulls_last("customer_city"),
        F.asc_nulls_last("customer_state"),
    ],
    "delivery_performance": lambda: [
        F.asc_nulls_last("avg_delivery_days"),
        F.asc_nulls_last("customer_state"),
    ],
}


def in_report_order(table: str, df: DataFrame) -> DataFrame:
    """Sort a mart for delivery; tables without a report order pass unchanged."""
    return df.orderBy(*_ORDER[table]()) if table in _ORDER else df


def first_rows(table: str, df: DataFrame, n: int) -> DataFrame:
    """First ``n`` rows in report order (top-k, without a full sort)."""
    return in_report_order(table, df).limit(n)
