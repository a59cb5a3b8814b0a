"""Random small inputs with every awkward property, in Spark and in DuckDB."""

import random

import duckdb

from tradewind.sources.extract import extract

SCHEMAS = {
    "raw_orders": "order_id string, customer_id string, order_status string,"
    " order_purchase_timestamp string, order_approved_at string,"
    " order_delivered_carrier_date string, order_delivered_customer_date string,"
    " order_estimated_delivery_date string",
    "raw_customers": "customer_id string, customer_unique_id string,"
    " customer_zip_code_prefix string, customer_city string, customer_state string",
    "raw_order_items": "order_id string, order_item_id int, product_id string, seller_id string,"
    " price decimal(18,4), freight_value decimal(18,4)",
    "raw_products": "product_id string, product_category_name string",
    "raw_category_translation": "product_category_name string,"
    " product_category_name_english string",
    "raw_order_payments": "order_id string, payment_sequential int, payment_type string,"
    " payment_installments int, payment_value decimal(18,4)",
}


def _money(rng):
    from decimal import Decimal

    return None if rng.random() < 0.1 else Decimal(rng.randrange(1, 100_000)) / 100


def _time(rng):
    if rng.random() < 0.1:
        return rng.choice([None, "bad", "2020-01-05", "2020-01-05T10:00:00"])
    return f"2020-01-{rng.randrange(1, 20):02d} {rng.randrange(24):02d}:{rng.randrange(60):02d}:07"


def make_rows(seed, duplicates):
    """Rows of the six raw tables; a third of items and orders share one key."""
    rng = random.Random(seed)
    hot = 0.34

    def pick(prefix, n):
        return f"{prefix}0" if rng.random() < hot else f"{prefix}{rng.randrange(n)}"

    orders = [
        (f"o{i}", pick("c", 25), rng.choice(["delivered"] * 4 + ["shipped", None]))
        + tuple(_time(rng) for _ in range(5))
        for i in range(60)
    ]
    customers = [
        (f"c{i}", f"u{i // 2}" if i % 7 else None, f"0{i}", rng.choice(["x", "y", None]),
         rng.choice(["S1", "S2", None]))
        for i in range(22)
    ]
    items = [
        (pick("o", 70), rng.choice([None, 1, 2, 3]), pick("p", 14), "s", _money(rng), _money(rng))
        for _ in range(150)
    ]
    items += [items[0]] * 20
    products = [(f"p{i}", rng.choice(["a", "b", "c", None])) for i in range(10)]
    payments = [
        (pick("o", 70), i, rng.choice(["card", "cash", None]), rng.randrange(1, 5), _money(rng))
        for i in range(120)
    ]
    translation = [("a", "apples"), ("b", "berries")]
    if duplicates:
        orders += [orders[1], orders[2][:1] + orders[3][1:]]
        customers += [customers[0], customers[1][:1] + customers[2][1:]]
        products += [products[0], ("p1", "c")]
        translation += [("a", "apfel")]
    return {
        "raw_orders": orders,
        "raw_customers": customers,
        "raw_order_items": items,
        "raw_products": products,
        "raw_category_translation": translation,
        "raw_order_payments": payments,
    }


class SmallSource:
    """Serves the rows to Spark."""

    def __init__(self, spark, rows):
        self.frames = {n: spark.createDataFrame(rows[n], SCHEMAS[n]) for n in SCHEMAS}
        payments = self.frames["raw_order_payments"]
        self.frames["raw_order_payments"] = payments.withColumnRenamed("payment_sequential", "_ord")

    def table(self, name):
        return self.frames[name]


def small_inputs(spark, seed, duplicates=False):
    """Extracted inputs, and DuckDB with the same raw tables."""
    return inputs_of(spark, make_rows(seed, duplicates))


def inputs_of(spark, rows):
    """As :func:`small_inputs`, for given rows."""
    db = duckdb.connect()
    for name, schema in SCHEMAS.items():
        columns = schema.replace(" string", " varchar")
        db.execute(f"CREATE TABLE {name} ({columns})")
        marks = ",".join("?" * len(rows[name][0]))
        db.executemany(f"INSERT INTO {name} VALUES ({marks})", rows[name])
    return extract(SmallSource(spark, rows)), db
