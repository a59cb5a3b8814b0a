"""Every registered query against its DuckDB statement on the given tables."""

import pytest
from conftest import TESTDATA, oracle_rows, rows_of

import __spark_entry__ as contract
from tradewind.catalogue import oracle
from tradewind.catalogue import queries as catalogue

QUERIES = catalogue.queries()
ORACLE = oracle.oracle_sql()


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert QUERIES.items() <= contract.queries().items()
    assert ORACLE.items() <= contract.oracle_sql().items()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_oracle(spark, given_db, name):
    df = QUERIES[name](spark, str(TESTDATA / "sf0.001"))
    expected = given_db.execute(ORACLE[name]).description
    assert sorted(df.columns) == sorted(column[0] for column in expected)
    assert rows_of(df) == oracle_rows(given_db, ORACLE[name])


def test_entry_runs(spark):
    df = contract.entry(spark)
    assert df.columns == [
        "order_date", "total_orders", "total_items", "total_revenue", "avg_order_value",
    ]
    assert df.count() == 439
