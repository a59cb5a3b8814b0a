import sys
from pathlib import Path

import duckdb
import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from tradewind.catalogue.oracle import CTES  # noqa: E402
from tradewind.session import local_session  # noqa: E402

TESTDATA = Path("/root/testdata")
GIVEN = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "tradewind-tests", **{"spark.driver.memory": "4g"})
    yield session
    session.stop()


@pytest.fixture
def conf(spark):
    """Set session settings for one test."""
    before = {}

    def put(key, value):
        before.setdefault(key, spark.conf.get(key, None))
        spark.conf.set(key, value)

    yield put
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.fixture(scope="session")
def given_db():
    """DuckDB with the given tables at the smallest scale."""
    db = duckdb.connect()
    for name in GIVEN:
        db.execute(
            f"CREATE VIEW {name} AS SELECT * FROM '{TESTDATA / 'sf0.001' / name}.parquet'"
        )
    return db


def rows_of(df):
    """Rows as a sorted list of tuples with columns in name order."""
    names = sorted(df.columns)
    return sorted((tuple(row[n] for n in names) for row in df.collect()), key=repr)


def oracle_rows(db, statement):
    """As :func:`rows_of`, for a DuckDB statement."""
    cursor = db.execute(statement)
    columns = [d[0] for d in cursor.description]
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(row[i] for i in order) for row in cursor.fetchall()), key=repr)


def derived_ctes(select):
    """A statement whose raw tables are real tables instead of mapped ones."""
    named = [f"{name} AS ({body})" for name, body in CTES.items() if not name.startswith("raw_")]
    return f"WITH {', '.join(named)} {select}"
