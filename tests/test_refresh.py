"""Refreshing from new loads only, against the full refresh over all of them."""

import random

import pytest
from conftest import rows_of
from small import SCHEMAS, make_rows

from tradewind import refresh
from tradewind.operators.clean import clean_orders
from tradewind.plans import rollups
from tradewind.refresh import INCREMENTS, OrderStates, OvertakenError, order_marts
from tradewind.session import put_if_absent
from tradewind.sinks.tables import ParquetSink
from tradewind.sources.tables import LoadZone

MARTS = ("daily_revenue", "customer_summary", "delivery_performance", "dim_date")


def dealt_rows(seed, loads):
    """Rows of each load: items and payments anywhere, orders again with other headers."""
    rng, rows = random.Random(seed), make_rows(seed, False)
    rows["raw_orders"] = list({r[0]: r for r in rows["raw_orders"]}.values())
    rows["raw_customers"] = list({r[0]: r for r in rows["raw_customers"]}.values())
    out = [{name: [] for name in INCREMENTS} for _ in range(loads)]
    for name in INCREMENTS[1:]:
        for row in rows[name]:
            out[rng.randrange(loads)][name].append(row)
    for row in rows["raw_orders"]:
        places = sorted(rng.sample(range(loads), rng.randrange(1, loads + 1)))
        for at in places[:-1]:
            out[at]["raw_orders"].append((*row[:2], rng.choice(["shipped", None, "delivered"]), *row[3:]))
        out[places[-1]]["raw_orders"].append(row)
    return out, rows


def entered(spark, zone, at, tables, skip=()):
    load_id = f"2024010{at}T000000-x"
    names = [n for n in tables if n not in skip]
    for name in names:
        ParquetSink(zone.folder(load_id)).write(spark.createDataFrame(tables[name], SCHEMAS[name]), name)
    zone.enter(load_id, names)
    return load_id


def full(spark, loads, customers):
    """Order totals and marts over everything at once."""
    last = {row[0]: row for tables in loads for row in tables["raw_orders"]}
    frames = {
        name: spark.createDataFrame([r for t in loads for r in t[name]], SCHEMAS[name])
        for name in INCREMENTS[1:]
    }
    orders = clean_orders(spark.createDataFrame(list(last.values()), SCHEMAS["raw_orders"]))
    totals = rollups.order_totals(orders, frames["raw_order_items"], frames["raw_order_payments"])
    return totals, order_marts(totals, customers)


@pytest.mark.parametrize("seed", [1, 5])
def test_every_refresh_equals_the_full_one(spark, tmp_path, seed):
    loads, rows = dealt_rows(seed, 3)
    customers = spark.createDataFrame(rows["raw_customers"], SCHEMAS["raw_customers"])
    zone, states = LoadZone(spark, f"{tmp_path}/raw"), OrderStates(spark, f"{tmp_path}/states")
    for at, tables in enumerate(loads):
        load_id = entered(spark, zone, at, tables)
        assert states.advance(zone) == [load_id] and states.version() == at + 1
        totals, want = full(spark, loads[: at + 1], customers)
        assert rows_of(states.totals()) == rows_of(totals.select(*states.totals().columns))
        got = order_marts(states.totals(), customers)
        for name in MARTS:
            assert rows_of(got[name]) == rows_of(want[name]), (at, name)
    assert states.advance(zone) == [] and states.version() == 3


def test_a_load_that_is_entered_late(spark, tmp_path):
    """The first load comes last: what it adds counts, its old headers do not."""
    loads, rows = dealt_rows(3, 3)
    zone, states = LoadZone(spark, f"{tmp_path}/raw"), OrderStates(spark, f"{tmp_path}/states")
    for at in (1, 2, 0):
        entered(spark, zone, at, loads[at])
        states.advance(zone)
    totals, _ = full(spark, loads, spark.createDataFrame(rows["raw_customers"], SCHEMAS["raw_customers"]))
    assert rows_of(states.totals()) == rows_of(totals.select(*states.totals().columns))


def test_several_loads_at_once_and_missing_tables(spark, tmp_path):
    loads, rows = dealt_rows(4, 3)
    loads[1]["raw_order_payments"] = []
    zone, states = LoadZone(spark, f"{tmp_path}/raw"), OrderStates(spark, f"{tmp_path}/states")
    with pytest.raises(LookupError):
        states.totals()
    for at in range(3):
        entered(spark, zone, at, loads[at], skip=("raw_order_payments",) if at == 1 else ())
    assert len(states.advance(zone)) == 3 and states.version() == 1
    totals, _ = full(spark, loads, spark.createDataFrame(rows["raw_customers"], SCHEMAS["raw_customers"]))
    assert rows_of(states.totals()) == rows_of(totals.select(*states.totals().columns))


def test_of_two_refreshes_one_fails(spark, tmp_path, monkeypatch):
    loads, _ = dealt_rows(2, 2)
    zone, states = LoadZone(spark, f"{tmp_path}/raw"), OrderStates(spark, f"{tmp_path}/states")
    entered(spark, zone, 0, loads[0])
    states.advance(zone)
    before = rows_of(states.totals())
    entered(spark, zone, 1, loads[1])

    def taken(session, path, text):
        if path.endswith("000000000002"):
            return False
        return put_if_absent(session, path, text)

    monkeypatch.setattr(refresh, "put_if_absent", taken)
    with pytest.raises(OvertakenError):
        states.advance(zone)
    assert rows_of(states.totals()) == before and states.version() == 1


def test_old_items_are_not_read_again(spark, tmp_path):
    loads, _ = dealt_rows(2, 2)
    zone, states = LoadZone(spark, f"{tmp_path}/raw"), OrderStates(spark, f"{tmp_path}/states")
    entered(spark, zone, 0, loads[0])
    states.advance(zone)
    files = states.totals().inputFiles()
    assert files and all("/states/states/" in f for f in files)
