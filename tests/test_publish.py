"""Overlapping runs: commits by number."""

from concurrent.futures import ThreadPoolExecutor

import pytest
from conftest import rows_of
from pyspark.sql import functions as F
from small import SmallSource, make_rows

from tradewind import job
from tradewind.job import Config, run
from tradewind.plans.star import clustered_by_month
from tradewind.schemas import WAREHOUSE_COLUMNS
from tradewind.session import child_files, put_if_absent, read_text
from tradewind.sinks import publish as publishing
from tradewind.sinks.publish import (
    SupersededError,
    begin_run,
    expire_runs,
    last_commit,
    mark_published,
    published_fact,
    published_run,
    read_published,
)


def test_put_if_absent(spark, tmp_path):
    folder = f"{tmp_path}/new/folder"
    assert child_files(spark, folder) == []
    assert put_if_absent(spark, f"{folder}/000001", "first é") is True
    assert put_if_absent(spark, f"{folder}/000001", "second") is False
    assert read_text(spark, f"{folder}/000001") == "first é"
    # No drafts stay.
    assert child_files(spark, folder) == ["000001"]


def test_numbers_are_given_once(spark, tmp_path):
    with ThreadPoolExecutor(8) as pool:
        numbers = list(pool.map(lambda i: begin_run(spark, str(tmp_path), f"r{i}"), range(24)))
    assert sorted(numbers) == list(range(1, 25))


def test_late_old_run_fails(spark, tmp_path):
    target = str(tmp_path)
    assert published_run(spark, target) is None and last_commit(spark, target) == (0, 0, None)
    old, new = begin_run(spark, target, "old"), begin_run(spark, target, "new")
    mark_published(spark, target, "new", new)
    with pytest.raises(SupersededError, match="run old is older than new"):
        mark_published(spark, target, "old", old)
    assert published_run(spark, target) == "new" and last_commit(spark, target)[0] == 1


def test_new_run_follows_an_old_one(spark, tmp_path):
    target = str(tmp_path)
    old, new = begin_run(spark, target, "old"), begin_run(spark, target, "new")
    mark_published(spark, target, "old", old)
    mark_published(spark, target, "new", new)
    mark_published(spark, target, "newest")
    assert published_run(spark, target) == "newest" and last_commit(spark, target)[0] == 3


@pytest.mark.parametrize("faster", ["newer", "older"])
def test_commit_between_look_and_put(spark, tmp_path, monkeypatch, faster):
    """The other run commits after this one has looked: it looks again."""
    target = str(tmp_path)
    numbers = {name: begin_run(spark, target, name) for name in ("older", "newer")}
    slower = "older" if faster == "newer" else "newer"
    put, calls = publishing.put_if_absent, []

    def interrupted(session, path, text):
        if not calls:
            calls.append(path)
            assert put(session, path, f"{numbers[faster]} {faster}")
        return put(session, path, text)

    monkeypatch.setattr(publishing, "put_if_absent", interrupted)
    if slower == "older":
        with pytest.raises(SupersededError):
            mark_published(spark, target, slower, numbers[slower])
    else:
        mark_published(spark, target, slower, numbers[slower])
    assert published_run(spark, target) == "newer"


def test_overlapping_refreshes(spark, tmp_path, monkeypatch):
    """A whole run begins and ends while another builds its tables."""
    target, build, inner = str(tmp_path), job.build, []

    def slow_build(*args):
        if not inner:
            inner.append(None)
            inner[0] = run(spark, SmallSource(spark, make_rows(2, False)), Config(target))
        return build(*args)

    monkeypatch.setattr(job, "build", slow_build)
    outer = run(spark, SmallSource(spark, make_rows(1, False)), Config(target))
    assert inner[0].succeeded and not outer.succeeded and "older than" in outer.error
    assert published_run(spark, target) == inner[0].run_id
    fact = read_published(spark, target)["fact_order_items"].count()
    assert fact == inner[0].rows["fact_order_items"]
    # The failed run is reported, and its folder can go.
    statuses = {r["run_id"]: r["status"] for r in spark.read.parquet(f"{target}/_reports").collect()}
    assert statuses == {inner[0].run_id: "succeeded", outer.run_id: "failed"}
    assert expire_runs(spark, target, 0) == [outer.run_id]


def plan_of(df):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def test_fact_by_month(spark, tmp_path):
    """The same table in monthly folders; a filter on dim_date decides which are read."""
    target = str(tmp_path)
    spread = F.expr("replace(order_purchase_timestamp, '2020-01-0', '2020-03-0')")

    class Spread(SmallSource):
        def table(self, name):
            frame = super().table(name)
            return frame.withColumn("order_purchase_timestamp", spread) if name == "raw_orders" else frame

    source = Spread(spark, make_rows(1, False))
    assert run(spark, source, Config(f"{target}/a")).succeeded
    assert run(spark, source, Config(f"{target}/b", fact_by_month=True)).succeeded
    plain, monthly = (read_published(spark, f"{target}/{x}") for x in "ab")
    for name in plain:
        assert rows_of(plain[name]) == rows_of(monthly[name]), name
    folders = {f.split("order_month=")[1].split("/")[0] for f in monthly["fact_order_items"].inputFiles()}
    assert folders == {"202001", "202003", "__HIVE_DEFAULT_PARTITION__"}
    days = monthly["dim_date"].filter("month = 3 AND day_of_week < 5")
    found = published_fact(spark, f"{target}/b", days)
    assert "dynamicpruningexpression(order_month" in plan_of(found)
    want = plain["fact_order_items"].filter("month(order_date) = 3 AND weekday(order_date) < 5")
    columns = WAREHOUSE_COLUMNS["fact_order_items"]
    assert rows_of(found.select(*columns)) == rows_of(want) and want.count() > 0
    # A fact that is not in folders gives the same rows.
    assert rows_of(published_fact(spark, f"{target}/a", days).select(*columns)) == rows_of(want)


def test_hot_day_is_several_tasks(spark, conf):
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    fact = spark.range(20_000).selectExpr(
        "id AS order_id", "CASE WHEN id % 3 > 0 THEN date'2020-05-05' WHEN id % 2 = 0 THEN NULL"
        " ELSE date_add(date'2020-01-01', CAST(id % 300 AS INT)) END AS order_date",
    )
    dealt = clustered_by_month(fact).withColumn("task", F.spark_partition_id())
    sizes = [r["count"] for r in dealt.groupBy("task").count().collect()]
    assert len(sizes) == 8 and max(sizes) < 2 * 20_000 / 8
    pairs = dealt.select("task", "order_month").distinct().count()
    assert pairs <= 8 + dealt.select("order_month").distinct().count()
