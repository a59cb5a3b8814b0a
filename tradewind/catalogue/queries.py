"""One query per operator, over the given tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewind.catalogue.fixtures import GivenTables, given_inputs
from tradewind.functions.numbers import round_half_even
from tradewind.job import Config, load_csv, run
from tradewind.operators import clean
from tradewind.operators.aggregates import (
    keep_first,
    payments_per_order,
    row_order,
    timestamp_bounds,
)
from tradewind.operators.calendar import date_spine
from tradewind.operators.joins import fan_out_join, lookup_join
from tradewind.operators.ordering import first_rows, in_report_order
from tradewind.plans import marts, star
from tradewind.plans.master import master
from tradewind.plans.warehouse import builders, transform
from tradewind.quality import check_keys
from tradewind.refresh import INCREMENTS, OrderStates, order_marts
from tradewind.schemas import ORDINAL, RAW_TABLES, WAREHOUSE_COLUMNS, RawTable
from tradewind.session import configure, fit_shuffles, scratch_dir
from tradewind.sinks.buckets import lay_out
from tradewind.sinks.publish import publish, published_fact, read_published, run_zone
from tradewind.sinks.tables import ParquetSink
from tradewind.sources.csv import ingest, read_csv
from tradewind.sources.extract import extract
from tradewind.sources.tables import CatalogZone, LoadZone, ParquetZone, query_tables

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    """Register a query under its function name, run with the library's settings."""

    def configured(spark: SparkSession, sf_dir: str) -> DataFrame:
        configure(spark)
        fit_shuffles(spark, _raw(spark, sf_dir, "raw_order_items"))
        return function(spark, sf_dir)

    _QUERIES[function.__name__] = configured
    return function


def queries() -> dict[str, Query]:
    """All registered queries by name."""
    return dict(_QUERIES)


def _raw(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return GivenTables(spark, sf_dir).table(name)


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.clean_orders(_raw(spark, sf_dir, "raw_orders"))


def _delivered_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = _raw(spark, sf_dir, "raw_order_items")
    return fan_out_join(_orders(spark, sf_dir), items, "order_id")


def _master(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = given_inputs(spark, sf_dir)
    return master(clean.clean_orders(data["orders"]), data["customers"], data["order_items"],
                  data["products"], data["payments"])


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = given_inputs(spark, sf_dir)
    return star.item_lines(
        data["order_items"], clean.clean_orders(data["orders"]), data["products"]
    )


def _warehouse(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return transform(given_inputs(spark, sf_dir))


def _mart(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return builders(given_inputs(spark, sf_dir))[name]()


def _laid_out(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The inputs from catalog tables in buckets of order_id, four or as many as the sizes need."""
    folder = scratch_dir(spark, "buckets")
    database = "tw_" + folder.rpartition("-")[2]
    spark.sql(f"CREATE DATABASE {database} LOCATION '{folder}/db'")
    lay_out(spark, {name: _raw(spark, sf_dir, name) for name in RAW_TABLES}, database, least=4)
    return extract(CatalogZone(spark, database))


def _doubles(df: DataFrame) -> DataFrame:
    """Money as double, as results are delivered; without the row ordinal."""
    money = {f.name: F.col(f.name).cast("double") for f in df.schema
             if isinstance(f.dataType, T.DecimalType)}
    return (df.withColumns(money) if money else df).drop(ORDINAL)


def _row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def _write_csv(spark: SparkSession, tables: dict[str, DataFrame]) -> str:
    """Write raw tables as CSV folders for the CSV readers to load."""
    folder = scratch_dir(spark, "csv")
    for name, raw in tables.items():
        raw.drop(ORDINAL).write.options(header=True, escape='"').csv(f"{folder}/{name}.csv")
    return folder


def _load(spark: SparkSession, tables: dict[str, DataFrame], names: list[str]) -> LoadZone:
    """Raw tables by way of CSV files and a load of the named ones."""
    folder = _write_csv(spark, tables)
    root = scratch_dir(spark, "raw")
    load_csv(spark, folder, root, manifest={f"{name}.csv": name for name in names})
    return LoadZone(spark, root)


def _ingested(spark: SparkSession, sf_dir: str, present: list[str]) -> dict[str, DataFrame]:
    zone = _load(spark, {n: _raw(spark, sf_dir, n) for n in present}, list(RAW_TABLES))
    return {name: zone.table(name) for name in present}


def _published(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """What readers see after a run of the job."""
    target = scratch_dir(spark, "warehouse")
    report = run(spark, GivenTables(spark, sf_dir), Config(target))
    if not report.succeeded:
        raise RuntimeError(report.error)
    return read_published(spark, target)


# --- sources and sinks


@query
def s1_csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = _write_csv(spark, {"raw_order_items": _raw(spark, sf_dir, "raw_order_items")})
    return _doubles(read_csv(spark, f"{folder}/raw_order_items.csv", RAW_TABLES["raw_order_items"]))


@query
def s1_csv_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = _write_csv(spark, {"raw_products": _raw(spark, sf_dir, "raw_products")})
    undeclared = RawTable(T.StructType())
    return read_csv(spark, f"{folder}/raw_products.csv", undeclared, infer_undeclared=True)


@query
def s1_quoted_breaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    broken = F.regexp_replace("product_category_name", " ", "\n")
    products = _raw(spark, sf_dir, "raw_products").withColumn("product_category_name", broken)
    folder = _write_csv(spark, {"raw_products": products})
    table = RAW_TABLES["raw_products"]
    return read_csv(spark, f"{folder}/raw_products.csv", table).drop(ORDINAL)


@query
def s1_split_breaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As s1_quoted_breaks, with records found in byte ranges."""
    broken = F.regexp_replace("product_category_name", " ", "\n")
    products = _raw(spark, sf_dir, "raw_products").withColumn("product_category_name", broken)
    folder = _write_csv(spark, {"raw_products": products})
    table = RAW_TABLES["raw_products"]
    return read_csv(spark, f"{folder}/raw_products.csv", table, split_above=0).drop(ORDINAL)


@query
def s1_bad_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells that do not fit their type, spoilt by rule: words, too many decimals, a fraction."""
    spoilt = {"price": (101, "12,50"), "freight_value": (103, "1.23456"),
              "order_item_id": (107, "2.5")}
    items = _raw(spark, sf_dir, "raw_order_items").withColumns(
        {
            name: F.when(F.col("order_id") % n == 0, text).otherwise(F.col(name).cast("string"))
            for name, (n, text) in spoilt.items()
        }
    )
    folder = _write_csv(spark, {"raw_order_items": items})
    sink = ParquetSink(ParquetZone(spark, scratch_dir(spark, "raw")))
    manifest = {"raw_order_items.csv": "raw_order_items"}
    found = ingest(spark, folder, sink, manifest, on_bad_cells="count").bad_cells
    rows = [(table, column, n) for (table, column), n in found.items()]
    return spark.createDataFrame(rows, "table_name string, column_name string, bad_cells bigint")


@query
def s2_ingest_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _row_counts(_ingested(spark, sf_dir, list(RAW_TABLES)))


@query
def s2_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ingested(spark, sf_dir, ["raw_orders"])["raw_orders"]


@query
def s2_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ingested(spark, sf_dir, ["raw_customers"])["raw_customers"].drop(ORDINAL)


@query
def s2_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _doubles(_ingested(spark, sf_dir, ["raw_order_payments"])["raw_order_payments"])


@query
def s2_any_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table that is not declared, with inferred types."""
    sellers = _raw(spark, sf_dir, "raw_sellers")
    return _load(spark, {"raw_sellers": sellers}, ["raw_sellers"]).table("raw_sellers")


@query
def s3_skip_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    present = [name for name in RAW_TABLES if name != "raw_order_payments"]
    return _row_counts(_ingested(spark, sf_dir, present))


@query
def s4_raw_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    zone = ParquetZone(spark, scratch_dir(spark, "raw"))
    sink = ParquetSink(zone)
    sink.write(_raw(spark, sf_dir, "raw_orders"), "raw_order_payments")
    sink.write(_raw(spark, sf_dir, "raw_order_payments"), "raw_order_payments")
    return _doubles(zone.table("raw_order_payments"))


@query
def s5_orders_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _raw(spark, sf_dir, "raw_orders")


@query
def s5_customers_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _raw(spark, sf_dir, "raw_customers")


@query
def s5_items_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _doubles(_raw(spark, sf_dir, "raw_order_items"))


@query
def s5_payments_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _doubles(_raw(spark, sf_dir, "raw_order_payments"))


@query
def s6_products_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return given_inputs(spark, sf_dir)["products"]


@query
def s6_products_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    return query_tables(
        spark,
        """
        select product_id, product_category_name,
          coalesce(product_category_name_english, product_category_name) as category_english
        from {products} left join {translation} using (product_category_name)
        """,
        products=_raw(spark, sf_dir, "raw_products"),
        translation=_raw(spark, sf_dir, "raw_category_translation"),
    )


@query
def s7_warehouse_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    zone = ParquetZone(spark, scratch_dir(spark, "warehouse"))
    mart = t4_delivery_performance(spark, sf_dir)
    sink = ParquetSink(zone)
    for _ in range(2):
        sink.write(in_report_order("delivery_performance", mart), "delivery_performance")
    return zone.table("delivery_performance")


@query
def s8_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = scratch_dir(spark, "warehouse")
    publish(spark, _warehouse(spark, sf_dir), target, "only-run")
    return _row_counts(read_published(spark, target))


@query
def s11_extract_bundle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _row_counts(extract(GivenTables(spark, sf_dir)))


# --- projections and filters


@query
def p1_coerce_timestamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = clean.coerce_timestamps(_raw(spark, sf_dir, "raw_orders"))
    return parsed.drop("customer_id", "order_status")


@query
def p2_only_delivered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.only_status(_raw(spark, sf_dir, "raw_orders"))


@query
def p3_order_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orders(spark, sf_dir).select("order_id", "order_date")


@query
def p4a_master_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = _master(spark, sf_dir)
    return _doubles(wide.select("order_id", "order_item_id", "product_id", "revenue"))


@query
def p4b_fact_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = clean.with_revenue(_raw(spark, sf_dir, "raw_order_items"))
    return _doubles(lines.select("order_id", "order_item_id", "product_id", "revenue"))


@query
def p5_delivery_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.with_delivery_days(_orders(spark, sf_dir)).select("order_id", "delivery_days")


@query
def p6_fact_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return t5_fact_order_items(spark, sf_dir)


def _rounded_payments(spark: SparkSession, sf_dir: str, digits: int) -> DataFrame:
    payments = payments_per_order(_raw(spark, sf_dir, "raw_order_payments"))
    paid = round_half_even(F.col("payment_value"), digits)
    return payments.select("order_id", paid.alias("paid"))


@query
def p7_round_two_digits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded_payments(spark, sf_dir, 2)


@query
def p7_round_one_digit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded_payments(spark, sf_dir, 1)


# --- joins


@query
def j1_category_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookup_join(
        _raw(spark, sf_dir, "raw_products"),
        _raw(spark, sf_dir, "raw_category_translation"),
        "product_category_name",
    )


@query
def j2_orders_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = lookup_join(
        _orders(spark, sf_dir), _raw(spark, sf_dir, "raw_customers"), "customer_id"
    )
    return joined.select(
        "order_id", "customer_id", "customer_unique_id", "customer_city", "customer_state"
    )


@query
def j3_orders_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = _delivered_items(spark, sf_dir).select(
        "customer_id", "order_id", "order_item_id", "product_id", "seller_id",
        "price", "freight_value",
    )
    return _doubles(joined)


@query
def j4_items_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    products = given_inputs(spark, sf_dir)["products"]
    joined = lookup_join(_delivered_items(spark, sf_dir), products, "product_id")
    return joined.select("order_id", "order_item_id", "product_id", "category_english")


@query
def j5_payments_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _orders(spark, sf_dir).select("order_id", "customer_id")
    payments = payments_per_order(_raw(spark, sf_dir, "raw_order_payments"))
    return _doubles(lookup_join(orders, payments, "order_id"))


@query
def j6_delivery_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    delivery = clean.with_delivery_days(_orders(spark, sf_dir))
    joined = lookup_join(delivery, _raw(spark, sf_dir, "raw_customers"), "customer_id")
    return joined.select("order_id", "delivery_days", "customer_state")


@query
def j7_items_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    header = _orders(spark, sf_dir).select("order_id", "customer_id", "order_date", "order_status")
    return _doubles(lookup_join(_raw(spark, sf_dir, "raw_order_items"), header, "order_id"))


@query
def j8_fact_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lines(spark, sf_dir).select(
        "order_id", "order_item_id", "product_id", "category_english"
    )


# --- aggregates and dedupe


@query
def a1_payments_per_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _doubles(payments_per_order(_raw(spark, sf_dir, "raw_order_payments")))


@query
def a2_by_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.by_date(_master(spark, sf_dir))


@query
def a3_by_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.by_product(_master(spark, sf_dir))


@query
def a4_by_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.by_customer(_master(spark, sf_dir))


@query
def a5_by_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.by_state(_orders(spark, sf_dir), _raw(spark, sf_dir, "raw_customers"))


@query
def a6_timestamp_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return timestamp_bounds(_orders(spark, sf_dir))


@query
def a7_dedupe_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = _raw(spark, sf_dir, "raw_customers")
    return keep_first(customers, "customer_unique_id", row_order(customers, "customer_id"))


@query
def a7_first_by_recorded_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers whose recorded order runs against their keys."""
    customers = _raw(spark, sf_dir, "raw_customers").withColumn(ORDINAL, -F.col("customer_id"))
    return keep_first(customers, "customer_unique_id", row_order(customers, "customer_id"))


@query
def a8_dedupe_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    products = given_inputs(spark, sf_dir)["products"].select("product_id", "category_english")
    return keep_first(products, "product_id", row_order(products, "category_english"))


@query
def a8_dedupe_repeated_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products whose ids do repeat, some without a category."""
    products = given_inputs(spark, sf_dir)["products"].select(
        (F.col("product_id") % 97).alias("product_id"), "category_english"
    )
    return star.dim_products(products)


@query
def a9_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    zone = ParquetZone(spark, scratch_dir(spark, "counts"))
    sink = ParquetSink(zone)
    counts = {name: sink.write(df, name) for name, df in _warehouse(spark, sf_dir).items()}
    return spark.createDataFrame(list(counts.items()), "table_name string, row_count bigint")


# --- sorts and first rows


@query
def o1_sorted_by_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return in_report_order("daily_revenue", t1_daily_revenue(spark, sf_dir))


@query
def o2_sorted_by_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return in_report_order("top_products", t2_top_products(spark, sf_dir))


@query
def o3_sorted_by_spending(spark: SparkSession, sf_dir: str) -> DataFrame:
    return in_report_order("customer_summary", t3_customer_summary(spark, sf_dir))


@query
def o4_sorted_by_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return in_report_order("delivery_performance", t4_delivery_performance(spark, sf_dir))


@query
def o5_top5_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return first_rows("top_products", t2_top_products(spark, sf_dir), 5)


@query
def o5_first5_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return first_rows("daily_revenue", t1_daily_revenue(spark, sf_dir), 5)


@query
def o5_first3_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _raw(spark, sf_dir, "raw_orders").orderBy("order_id").limit(3)


# --- calendar


@query
def g1_date_spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return date_spine(timestamp_bounds(_orders(spark, sf_dir)))


@query
def g2_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.dim_date(_orders(spark, sf_dir))


# --- composite tables


@query
def c1_clean_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orders(spark, sf_dir)


@query
def c2_payments_per_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _doubles(payments_per_order(given_inputs(spark, sf_dir)["payments"]))


@query
def c3_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _doubles(_master(spark, sf_dir))


@query
def c3_master_in_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The master table without a shuffle of items or payments."""
    data = _laid_out(spark, sf_dir)
    return _doubles(
        master(clean.clean_orders(data["orders"]), data["customers"], data["order_items"],
               data["products"], data["payments"])
    )


@query
def t1_daily_revenue_in_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return builders(_laid_out(spark, sf_dir))["daily_revenue"]()


def _refreshed_by_loads(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Marts from order states of three loads: late items and payments, and orders that come
    again with their last status."""
    loads = LoadZone(spark, scratch_dir(spark, "loads"))
    raw = {name: _raw(spark, sf_dir, name) for name in INCREMENTS}
    early = F.when(F.col("order_id") % 3 == 0, "shipped").otherwise(F.col("order_status"))
    deal = {
        "raw_orders": (F.col("order_id") % 4 == 0).cast("int"),
        "raw_order_items": F.pmod(F.col("order_id") + F.col("order_item_id"), F.lit(3)),
        "raw_order_payments": F.pmod(F.col("order_id"), F.lit(2)) * 2,
    }
    states = OrderStates(spark, scratch_dir(spark, "states"))
    for at in range(3):
        tables = {name: df.filter(deal[name] == at) for name, df in raw.items()}
        if at < 2:
            tables["raw_orders"] = tables["raw_orders"].withColumn("order_status", early)
        else:
            tables["raw_orders"] = raw["raw_orders"].filter("order_id % 3 = 0")
        load_id = f"2024010{at}T000000-load"
        for name, df in tables.items():
            ParquetSink(loads.folder(load_id)).write(df, name)
        loads.enter(load_id, tables)
        states.advance(loads)
    return order_marts(states.totals(), _raw(spark, sf_dir, "raw_customers"))


@query
def x1_daily_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _refreshed_by_loads(spark, sf_dir)["daily_revenue"]


@query
def x1_customer_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _refreshed_by_loads(spark, sf_dir)["customer_summary"]


@query
def t5_fact_of_weekends(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Revenue on weekend days of one quarter, from a published fact in monthly folders."""
    target = scratch_dir(spark, "by-month")
    tables = _warehouse(spark, sf_dir)
    wanted = {name: tables[name] for name in ("fact_order_items", "dim_date")}
    publish(spark, wanted, target, "run", fact_by_month=True)
    dates = run_zone(spark, target, "run").table("dim_date")
    days = dates.filter("year = 1995 AND quarter = 2 AND is_weekend")
    money = F.sum(F.col("revenue").cast("decimal(18,4)")).cast("double")
    return (
        published_fact(spark, target, days)
        .groupBy("order_date", "day_name")
        .agg(F.count(F.lit(1)).alias("items"), round_half_even(money, 2).alias("revenue"))
    )


@query
def t5_fact_in_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return builders(_laid_out(spark, sf_dir))["fact_order_items"]()


@query
def c4_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return given_inputs(spark, sf_dir)["products"]


@query
def t1_daily_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mart(spark, sf_dir, "daily_revenue")


@query
def t1_daily_revenue_from_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.daily_revenue(_master(spark, sf_dir))


@query
def t2_top_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mart(spark, sf_dir, "top_products")


@query
def t2_top_products_from_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.top_products(_master(spark, sf_dir))


@query
def t3_customer_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mart(spark, sf_dir, "customer_summary")


@query
def t3_customer_summary_from_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.customer_summary(_master(spark, sf_dir))


@query
def t4_delivery_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.delivery_performance(_orders(spark, sf_dir), _raw(spark, sf_dir, "raw_customers"))


@query
def t5_fact_order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _doubles(_lines(spark, sf_dir))


@query
def t6_dim_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.dim_customers(_raw(spark, sf_dir, "raw_customers"))


@query
def t7_dim_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.dim_products(given_inputs(spark, sf_dir)["products"])


@query
def t8_dim_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.dim_date(_orders(spark, sf_dir))


# --- job


@query
def b1_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _row_counts(_published(spark, sf_dir))


def _register_published(name: str) -> None:
    """A query that returns the rows of one table as the job publishes it."""

    def published(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _published(spark, sf_dir)[name]

    published.__name__ = f"b1_{name}"
    query(published)


for _name in WAREHOUSE_COLUMNS:
    _register_published(_name)


@query
def b2_run_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = scratch_dir(spark, "warehouse")
    run(spark, GivenTables(spark, sf_dir), Config(target))
    stored = spark.read.parquet(f"{target}/_reports")
    return stored.select("table_name", "row_count", "status")


@query
def b2_run_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a run finds in its inputs and in its stored tables."""
    target = scratch_dir(spark, "warehouse")
    run(spark, GivenTables(spark, sf_dir), Config(target))
    return spark.read.parquet(f"{target}/_checks").select("check_name", "violations")


@query
def q1_key_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return check_keys(_published(spark, sf_dir))
