"""Raw tables in buckets of order_id: same results, no exchange on it."""

import re

import pytest
from conftest import rows_of
from pyspark.sql import functions as F
from small import SCHEMAS, make_rows

from tradewind.catalogue.queries import queries
from tradewind.operators.clean import clean_orders
from tradewind.plans import rollups, star
from tradewind.plans.master import master
from tradewind.plans.warehouse import UniqueKeys, transform
from tradewind.sinks import buckets as bucket_sink
from tradewind.sinks.buckets import ORDER_TABLES, buckets_for, hottest_share, lay_out
from tradewind.sources.extract import extract
from tradewind.sources.tables import CatalogZone


@pytest.fixture(scope="module")
def frames(spark):
    rows = make_rows(1, False)
    return {name: spark.createDataFrame(rows[name], schema) for name, schema in SCHEMAS.items()}


@pytest.fixture
def database(spark, tmp_path):
    spark.sql(f"create database laid_out location '{tmp_path}/db'")
    yield "laid_out"
    spark.sql("drop database laid_out cascade")


@pytest.fixture
def no_broadcast(conf):
    conf("spark.sql.autoBroadcastJoinThreshold", -1)
    conf("spark.sql.adaptive.autoBroadcastJoinThreshold", -1)


def plan_text(df):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple")


def formatted(df):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def exchanged(df):
    text = plan_text(df)
    found = re.findall(r"Exchange hashpartitioning\(([^)]*), \d+\)", text)
    return sorted({re.sub(r"#\d+L?", "", key) for key in found})


def plans(data):
    """T1, T5 and the order and item side of C3, whose customers would be broadcast or not."""
    orders = clean_orders(data["orders"])
    totals = rollups.order_totals(orders, data["order_items"], data["payments"])
    lines = star.item_lines(data["order_items"], orders, data["products"])
    wide = master(orders, data["customers"], data["order_items"], data["products"], data["payments"])
    return {"t1": rollups.daily_revenue(totals), "t5": lines, "c3": wide}


@pytest.mark.parametrize("buckets", [1, 4])
def test_no_exchange_on_the_order(spark, frames, database, no_broadcast, buckets):
    counts = lay_out(spark, frames, database, buckets=buckets)
    assert counts == {name: df.count() for name, df in frames.items()}
    data = extract(CatalogZone(spark, database))
    found = {name: exchanged(df) for name, df in plans(data).items()}
    assert all("order_id" not in found[name] for name in ("t1", "t5"))
    # Large customers are joined to the orders first. That moves orders, never items or payments.
    text = plan_text(plans(data)["c3"])
    moved = re.findall(r"Exchange hashpartitioning\(order_id#.*\n(.*)", text)
    assert 1 <= len(moved) <= 2 and not any("order_item_id" in m for m in moved)


def test_master_beside_small_customers(spark, frames, database, conf):
    """Where customers are broadcast nothing at all is shuffled by order."""
    lay_out(spark, frames, database, buckets=4)
    data = extract(CatalogZone(spark, database))
    for size in ("order_items", "payments", "orders"):
        data[size] = data[size].hint("merge")
    conf("spark.sql.autoBroadcastJoinThreshold", "1MB")
    assert "order_id" not in exchanged(plans(data)["c3"])


def test_results_are_the_same(spark, frames, database):
    class Plain:
        def table(self, name):
            return frames[name]

    lay_out(spark, frames, database, buckets=3)
    keys = UniqueKeys(True, True, True)
    plain = transform(extract(Plain()), keys)
    stored = transform(extract(CatalogZone(spark, database)), keys)
    for name in plain:
        assert rows_of(stored[name]) == rows_of(plain[name]), name


def test_one_file_per_bucket(spark, frames, database):
    lay_out(spark, frames, database, buckets=4)
    for name in ORDER_TABLES:
        table = spark.table(f"{database}.{name}")
        assert len(table.inputFiles()) <= 4
        text = spark.sql(f"describe extended {database}.{name}").filter("col_name like '%ucket%'")
        assert {r["data_type"] for r in text.collect()} == {"4", "[`order_id`]"}


def test_hot_order_is_stored_without_buckets(spark, frames, database, caplog):
    hot = F.when(F.col("order_item_id") >= 0, "o1").otherwise(F.col("order_id"))
    tables = frames | {"raw_order_items": frames["raw_order_items"].withColumn("order_id", hot)}
    assert hottest_share(tables["raw_order_items"], "order_id") > 0.5
    lay_out(spark, tables, database, buckets=16)
    assert "hot order_id in raw_order_items" in caplog.text
    described = spark.sql(f"describe extended {database}.raw_orders").filter("col_name like '%ucket%'")
    assert described.count() == 0


def test_number_of_buckets(spark, tmp_path):
    assert buckets_for() == 1 and buckets_for(spark.range(10)) == 1
    # 2^33 longs are 64 GB.
    assert buckets_for(spark.range(2**33), spark.range(5)) == 512
    assert buckets_for(spark.range(2**33 + 10**9)) == 1024
    assert hottest_share(spark.range(0).withColumn("k", F.lit(1)), "k") == 0


def put_given(spark, folder, orders):
    """The given tables with four equal lines to an order, which compress to next to nothing."""
    ids = spark.range(orders)
    tables = {
        "orders": ids.selectExpr("id as o_orderkey", "id % 7 as o_custkey", "'F' as o_orderstatus",
                                 "timestamp_ntz'1995-03-01 00:00:00' as o_orderdate"),
        "customer": spark.range(7).selectExpr("id as c_custkey", "0 as c_nationkey",
                                              "'x' as c_mktsegment"),
        "nation": spark.range(1).selectExpr("0 as n_nationkey", "'N' as n_name"),
        "part": spark.range(5).selectExpr("id as p_partkey", "'LARGE x y' as p_type"),
        "supplier": spark.range(3).selectExpr("id as s_suppkey", "'s' as s_name",
                                              "0 as s_nationkey"),
        "lineitem": ids.selectExpr("id as l_orderkey", "explode(array(1, 2, 3, 4)) as l_linenumber")
        .selectExpr("l_orderkey", "l_orderkey % 5 as l_partkey", "0L as l_suppkey", "l_linenumber",
                    "10D as l_extendedprice", "0.1D as l_tax", "'A' as l_returnflag"),
    }
    for name, df in tables.items():
        df.write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


@pytest.mark.parametrize("name", ["c3_master", "t1_daily_revenue", "t5_fact_order_items"])
def test_buckets_of_queries_grow_with_rows(spark, tmp_path, no_broadcast, monkeypatch, name):
    """A bucket holds no more rows of a table four times as large."""
    in_buckets = name.replace("_order_items", "") + "_in_buckets"
    monkeypatch.setattr(bucket_sink, "TARGET_PARTITION_BYTES", 64 * 1024)
    for orders, expected in ((1000, {"8"}), (4000, {"32"})):
        folder = put_given(spark, tmp_path / str(orders), orders)
        df = queries()[in_buckets](spark, folder)
        assert set(re.findall(r"SelectedBucketsCount: \d+ out of (\d+)", formatted(df))) == expected
        assert rows_of(df) == rows_of(queries()[name](spark, folder))
