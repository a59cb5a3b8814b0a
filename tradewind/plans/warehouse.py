"""Inputs to outputs: the whole warehouse as a dictionary of lazy plans."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.operators.clean import clean_orders, keyed
from tradewind.plans import marts, rollups, star
from tradewind.plans.master import master


@dataclass(frozen=True)
class UniqueKeys:
    """Whether the lookup tables have at most one row per key."""

    orders: bool
    customers: bool
    products: bool

    @property
    def all_hold(self) -> bool:
        return self.orders and self.customers and self.products


# Lookup tables whose keys must be unique for the rollup form of a mart. The other tables may
# repeat keys: the rollups count them as the master table does.
NEEDS = {
    "daily_revenue": ("customers", "products"),
    "top_products": ("customers",),
    "customer_summary": ("orders", "customers", "products"),
}


def count_duplicates(**keyed_tables: tuple[DataFrame, str]) -> dict[str, int]:
    """Number of keys that repeat, by table, in one job over all rows."""
    checks = None
    for name, (df, key) in keyed_tables.items():
        per_key = keyed(df.select(key), key).groupBy(key).count()
        check = per_key.agg(F.count_if(F.col("count") > 1).alias("n")).select(
            F.lit(name).alias("name"), "n"
        )
        checks = check if checks is None else checks.union(check)
    return {row["name"]: row["n"] for row in checks.collect()}


def measure_keys(orders: DataFrame, customers: DataFrame, products: DataFrame) -> UniqueKeys:
    """Check the three join keys over all rows, in one job that returns three numbers."""
    found = count_duplicates(
        orders=(orders, "order_id"),
        customers=(customers, "customer_id"),
        products=(products, "product_id"),
    )
    return UniqueKeys(**{name: n == 0 for name, n in found.items()})


def builders(
    data: dict[str, DataFrame], keys: UniqueKeys | None = None
) -> dict[str, Callable[[], DataFrame]]:
    """How to build each of the eight warehouse tables from the five extracted inputs.

    The three marts over items come from rollups where the lookup tables in ``NEEDS`` have
    unique keys, otherwise from the master table; the results are the same. ``keys=None``
    measures the keys that a mart needs when it is built, each table at most once.
    """
    orders = clean_orders(data["orders"])
    customers, items = data["customers"], data["order_items"]
    products, payments = data["products"], data["payments"]
    lookups = {"orders": (orders, "order_id"), "customers": (customers, "customer_id"),
               "products": (products, "product_id")}
    known = {} if keys is None else {name: getattr(keys, name) for name in lookups}

    def unique(mart: str) -> bool:
        missing = {name: lookups[name] for name in NEEDS[mart] if name not in known}
        if missing:
            known.update({name: n == 0 for name, n in count_duplicates(**missing).items()})
        return all(known[name] for name in NEEDS[mart])

    def totals() -> DataFrame:
        return rollups.order_totals(orders, items, payments)

    def wide() -> DataFrame:
        return master(orders, customers, items, products, payments)

    def daily_revenue() -> DataFrame:
        if unique("daily_revenue"):
            return rollups.daily_revenue(totals())
        return marts.daily_revenue(wide())

    def top_products() -> DataFrame:
        if unique("top_products"):
            return rollups.top_products(orders, items, products)
        return marts.top_products(wide())

    def customer_summary() -> DataFrame:
        if unique("customer_summary"):
            return rollups.customer_summary(totals(), customers)
        return marts.customer_summary(wide())

    return {
        "daily_revenue": daily_revenue,
        "top_products": top_products,
        "customer_summary": customer_summary,
        "delivery_performance": lambda: marts.delivery_performance(orders, customers),
        "fact_order_items": lambda: star.fact_order_items(items, orders, products),
        "dim_customers": lambda: star.dim_customers(customers),
        "dim_products": lambda: star.dim_products(products),
        "dim_date": lambda: star.dim_date(orders),
    }


def transform(data: dict[str, DataFrame], keys: UniqueKeys | None = None) -> dict[str, DataFrame]:
    """The eight warehouse tables from the five extracted inputs.

    All plans are lazy; without ``keys``, planning the marts over items runs jobs that count
    repeated keys.
    """
    return {name: build() for name, build in builders(data, keys).items()}
