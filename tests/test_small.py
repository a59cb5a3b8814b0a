"""Random small inputs against DuckDB: duplicates, nulls, hot keys, both mart forms."""

import pytest
from conftest import derived_ctes, oracle_rows, rows_of
from pyspark.sql import functions as F
from small import inputs_of, make_rows, small_inputs

from tradewind.operators.clean import clean_orders
from tradewind.operators.joins import fan_out_join
from tradewind.plans.master import master
from tradewind.plans.warehouse import UniqueKeys, builders, measure_keys, transform
from tradewind.quality import check_keys
from tradewind.schemas import WAREHOUSE_COLUMNS


@pytest.fixture(scope="module", params=[(1, False), (2, True), (3, True)], ids=str)
def case(spark, request):
    seed, duplicates = request.param
    data, db = small_inputs(spark, seed, duplicates)
    yield {name: df.cache() for name, df in data.items()}, db, duplicates
    for df in data.values():
        df.unpersist()


def test_measured_keys(case):
    data, _, duplicates = case
    keys = measure_keys(clean_orders(data["orders"]), data["customers"], data["products"])
    assert keys.all_hold is not duplicates


def test_warehouse_equals_oracle(case):
    data, db, _ = case
    tables = transform(data)
    assert {name: tuple(df.columns) for name, df in tables.items()} == WAREHOUSE_COLUMNS
    for name, df in tables.items():
        assert rows_of(df) == oracle_rows(db, derived_ctes(f"SELECT * FROM {name}")), name


def test_both_mart_forms_agree_on_unique_keys(case):
    data, db, duplicates = case
    if duplicates:
        pytest.skip("needs unique keys")
    general = transform(data, UniqueKeys(True, True, False))
    for name in ("daily_revenue", "top_products", "customer_summary"):
        assert rows_of(general[name]) == oracle_rows(db, derived_ctes(f"SELECT * FROM {name}"))


@pytest.mark.parametrize("partitions", [3, 11])
def test_fan_out_equals_left_join(case, partitions):
    data, _, _ = case
    orders = clean_orders(data["orders"]).select("order_id", "customer_id").repartition(3)
    items = data["order_items"].repartition(partitions)
    plain = orders.join(items, "order_id", "left")
    assert rows_of(fan_out_join(orders, items, "order_id")) == rows_of(plain)


def test_fan_out_on_an_unordered_source(spark):
    """Rows in another order on each reading: nothing may depend on their positions."""
    orders = spark.range(50).selectExpr("id AS k", "id * 10 AS o")
    items = spark.range(3000).selectExpr("if(id % 3 = 0, 7, id % 60) AS k", "id AS i")
    shuffled = items.orderBy(F.rand())
    got = fan_out_join(orders, shuffled, "k")
    assert rows_of(got) == rows_of(orders.join(items, "k", "left"))


def test_master_equals_oracle(case):
    data, db, _ = case
    wide = master(clean_orders(data["orders"]), data["customers"], data["order_items"],
                  data["products"], data["payments"])
    assert rows_of(wide) == oracle_rows(db, derived_ctes("SELECT * FROM master"))


def test_marts_hold_for_each_kind_of_repeated_key(spark):
    """Only the tables named in NEEDS may send a mart to the master table."""
    rows = make_rows(5, False)
    rows["raw_orders"] += [rows["raw_orders"][1], rows["raw_orders"][2][:1] + rows["raw_orders"][3][1:]]
    rows["raw_products"] += [rows["raw_products"][0], ("p1", "c")]
    data, db = inputs_of(spark, rows)
    keys = measure_keys(clean_orders(data["orders"]), data["customers"], data["products"])
    assert (keys.orders, keys.customers, keys.products) == (False, True, False)
    top = builders(data, keys)["top_products"]()
    assert rows_of(top) == oracle_rows(db, derived_ctes("SELECT * FROM top_products"))
    only_orders = {**rows, "raw_products": make_rows(5, False)["raw_products"]}
    data, db = inputs_of(spark, only_orders)
    daily = builders(data)["daily_revenue"]()
    assert rows_of(daily) == oracle_rows(db, derived_ctes("SELECT * FROM daily_revenue"))


@pytest.mark.parametrize("partitions", [1, 7])
def test_partitioning_does_not_change_results(case, conf, partitions):
    data, db, duplicates = case
    conf("spark.sql.shuffle.partitions", partitions)
    shuffled = {name: df.repartition(partitions + 1) for name, df in data.items()}
    tables = transform(shuffled)
    for name in ("daily_revenue", "top_products", "customer_summary", "delivery_performance",
                 "dim_customers", "dim_products"):
        assert rows_of(tables[name]) == oracle_rows(db, derived_ctes(f"SELECT * FROM {name}"))


def test_key_checks_count_broken_keys(case):
    data, db, _ = case
    found = {r["check_name"]: r["violations"] for r in check_keys(transform(data)).collect()}
    assert found["unique dim_customers"] == found["unique dim_products"] == 0
    duplicated = db.execute(
        derived_ctes(
            "SELECT count(*) FROM (SELECT order_id, order_item_id FROM fact_order_items"
            " GROUP BY ALL HAVING count(*) > 1)"
        )
    ).fetchall()
    assert found["unique fact_order_items"] == duplicated[0][0] > 0


def test_invariants(case):
    data, _, duplicates = case
    tables = transform(data)
    fact, items = tables["fact_order_items"], data["order_items"]
    if not duplicates:
        assert fact.count() == items.count()
    sold = tables["daily_revenue"].selectExpr("sum(total_items)").first()[0]
    dated = fact.filter("order_date is not null and order_item_id is not null").count()
    assert sold == dated if not duplicates else sold >= dated
    spine = {r[0] for r in tables["dim_date"].select("date").collect()}
    used = {r[0] for r in fact.select("order_date").dropna().distinct().collect()}
    assert used - spine <= {max(used)}
