"""Declared columns of the six raw tables and the eight warehouse tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 4)
ORDINAL = "_ord"


@dataclass(frozen=True)
class RawTable:
    """A raw table: its declared columns and whether row order carries meaning."""

    schema: T.StructType
    keeps_order: bool = False


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


_TEXT = T.StringType()

# The raw tables and their columns.
RAW_TABLES: dict[str, RawTable] = {
    "raw_orders": RawTable(
        _struct(
            order_id=_TEXT,
            customer_id=_TEXT,
            order_status=_TEXT,
            order_purchase_timestamp=_TEXT,
            order_approved_at=_TEXT,
            order_delivered_carrier_date=_TEXT,
            order_delivered_customer_date=_TEXT,
            order_estimated_delivery_date=_TEXT,
        )
    ),
    "raw_customers": RawTable(
        _struct(
            customer_id=_TEXT,
            customer_unique_id=_TEXT,
            customer_zip_code_prefix=_TEXT,
            customer_city=_TEXT,
            customer_state=_TEXT,
        ),
        keeps_order=True,
    ),
    "raw_order_items": RawTable(
        _struct(
            order_id=_TEXT,
            order_item_id=T.IntegerType(),
            product_id=_TEXT,
            seller_id=_TEXT,
            price=MONEY,
            freight_value=MONEY,
        )
    ),
    "raw_products": RawTable(
        _struct(product_id=_TEXT, product_category_name=_TEXT), keeps_order=True
    ),
    "raw_order_payments": RawTable(
        _struct(
            order_id=_TEXT,
            payment_type=_TEXT,
            payment_installments=T.IntegerType(),
            payment_value=MONEY,
        ),
        keeps_order=True,
    ),
    "raw_category_translation": RawTable(
        _struct(product_category_name=_TEXT, product_category_name_english=_TEXT)
    ),
}

# The column that each raw table is best divided by.
RAW_KEYS = {
    "raw_orders": "order_id",
    "raw_customers": "customer_id",
    "raw_order_items": "order_id",
    "raw_products": "product_id",
    "raw_order_payments": "order_id",
    "raw_category_translation": "product_category_name",
}

MONEY_COLUMNS = ("price", "freight_value", "payment_value")

# File name -> table; pass another mapping to ingest files that are named differently.
DEFAULT_MANIFEST = {f"{table.removeprefix('raw_')}.csv": table for table in RAW_TABLES}

# The timestamp columns of an order and their text format.
ORDER_TIMESTAMPS = (
    "order_purchase_timestamp",
    "order_approved_at",
    "order_delivered_carrier_date",
    "order_delivered_customer_date",
    "order_estimated_delivery_date",
)
TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"
DELIVERED = "delivered"

# The warehouse tables and their columns.
WAREHOUSE_COLUMNS: dict[str, tuple[str, ...]] = {
    "daily_revenue": (
        "order_date", "total_orders", "total_items", "total_revenue", "avg_order_value",
    ),
    "top_products": (
        "product_id", "category_english", "total_items_sold", "total_revenue", "avg_price",
    ),
    "customer_summary": (
        "customer_unique_id", "customer_city", "customer_state",
        "total_orders", "total_spent", "first_order", "last_order",
    ),
    "delivery_performance": (
        "customer_state", "total_orders",
        "avg_delivery_days", "min_delivery_days", "max_delivery_days",
    ),
    "fact_order_items": (
        "order_item_id", "order_id", "product_id", "seller_id", "customer_id", "order_date",
        "category_english", "price", "freight_value", "revenue", "order_status",
    ),
    "dim_customers": (
        "customer_id", "customer_unique_id", "customer_city", "customer_state",
        "customer_zip_code_prefix",
    ),
    "dim_products": ("product_id", "category_english"),
    "dim_date": (
        "date", "day", "month", "month_name", "quarter", "year",
        "day_of_week", "day_name", "is_weekend",
    ),
}
