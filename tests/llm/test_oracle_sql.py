"""The operators that SQL can express, on the given tables and on awkward ones."""

import duckdb
import llm_cases as cases
import pytest
from conftest import TESTDATA
from test_chat import SCHEMA as CONVERSATION_SCHEMA
from test_chat import rows as conversation_rows
from test_decontaminate import ITEM_SCHEMA, ITEMS, leaking_rows
from test_lines import shared_rows
from test_warc import PAGE_SCHEMA, page_rows

from tradewind.llm import queries


def compare(spark, name, folder, pattern):
    db = duckdb.connect()
    for table in ("documents", "benchmark", "pages", "conversations"):
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet{pattern}'")
    got = queries.QUERIES[name](spark, str(folder))
    cursor = db.execute(queries.ORACLE_SQL[name])
    names = [c[0] for c in cursor.description]
    assert sorted(names) == sorted(got.columns)
    assert cases.tuples(got, *names) == sorted(cursor.fetchall(), key=repr)


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_given_tables(spark, name):
    compare(spark, name, TESTDATA / "sf0.001", "")


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_awkward_tables(spark, tmp_path, name):
    rows = shared_rows() + leaking_rows()
    cases.stored_documents(cases.table(spark, rows), tmp_path)
    spark.createDataFrame(ITEMS, ITEM_SCHEMA).write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame(page_rows(), PAGE_SCHEMA).write.parquet(f"{tmp_path}/pages.parquet")
    turns = spark.createDataFrame(conversation_rows(), CONVERSATION_SCHEMA)
    turns.write.parquet(f"{tmp_path}/conversations.parquet")
    compare(spark, name, tmp_path, "/*.parquet")
