"""Key, grain and foreign-key checks on the warehouse tables."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Columns that identify a row of each table.
GRAIN = {
    "daily_revenue": ("order_date",),
    "top_products": ("product_id", "category_english"),
    "customer_summary": ("customer_unique_id", "customer_city", "customer_state"),
    "delivery_performance": ("customer_state",),
    "fact_order_items": ("order_id", "order_item_id"),
    "dim_customers": ("customer_unique_id",),
    "dim_products": ("product_id",),
    "dim_date": ("date",),
}
# Fact column -> dimension and the column it refers to.
FOREIGN_KEYS = {
    "product_id": ("dim_products", "product_id"),
    "customer_id": ("dim_customers", "customer_id"),
    "order_date": ("dim_date", "date"),
}


def duplicate_keys(df: DataFrame, *keys: str) -> DataFrame:
    """Keys that occur on more than one row, with their row count."""
    return df.groupBy(*keys).count().filter(F.col("count") > 1)


def orphan_keys(fact: DataFrame, column: str, dimension: DataFrame, key: str) -> DataFrame:
    """Non-null fact keys without a dimension row, with their row count."""
    used = fact.dropna(subset=[column]).groupBy(column).count()
    known = dimension.select(F.col(key).alias(column))
    return used.join(known, column, "left_anti")


def check_keys(tables: dict[str, DataFrame], grains: Iterable[str] = tuple(GRAIN)) -> DataFrame:
    """One row per check with the number of keys that break it.

    ``tables`` should be stored ones: each check scans its own columns of them. ``grains``
    names the tables whose grain is checked.

    Dimension customers keep the first ``customer_id`` of a person, so fact rows of
    the person's later ids count as orphans; the last purchase day can be missing
    from ``dim_date``.
    """
    checks = [
        (f"unique {name}", duplicate_keys(tables[name], *keys))
        for name, keys in GRAIN.items()
        if name in tables and name in grains
    ]
    fact = tables.get("fact_order_items")
    if fact is not None:
        checks += [
            (f"fact {column} in {name}", orphan_keys(fact, column, tables[name], key))
            for column, (name, key) in FOREIGN_KEYS.items()
            if name in tables
        ]
    counted = [
        found.agg(F.count(F.lit(1)).alias("violations")).select(
            F.lit(label).alias("check_name"), "violations"
        )
        for label, found in checks
    ]
    return reduce(DataFrame.union, counted)
