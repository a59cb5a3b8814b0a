"""Publishing a full refresh: write everything, then repoint.

Each run writes its tables under ``<target>/_runs/<run_id>``. Readers follow the last commit below
``<target>/_commits``, which a run adds only after all of its tables are complete, so a
failed run leaves the last good tables visible.

Runs may overlap. Each takes a number when it begins (``<target>/_started``), and commits are numbered
too; both are files that are put in place only where no file of that number is. A run
commits only if no run that began later has, so a late old run never hides a newer one. Clocks play no part.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.operators.ordering import in_report_order
from tradewind.plans.star import MONTH, clustered_by_month, fact_on_days, month_number
from tradewind.schemas import WAREHOUSE_COLUMNS
from tradewind.session import (
    child_files,
    child_folders,
    delete_folder,
    in_parallel,
    put_if_absent,
    read_text,
)
from tradewind.sinks.tables import JdbcSink, ParquetSink
from tradewind.sources.tables import ParquetZone


def run_zone(spark: SparkSession, target: str, run_id: str) -> ParquetZone:
    """The folder of one run's tables."""
    return ParquetZone(spark, f"{target.rstrip('/')}/_runs/{run_id}")


def write_tables(
    zone: ParquetZone,
    tables: Mapping[str, Callable[[], DataFrame]],
    threads: int = 4,
    fact_by_month: bool = False,
) -> dict[str, int]:
    """Build and write warehouse tables in report order; row counts by table.

    With ``fact_by_month`` the fact is stored in monthly folders, see :func:`published_fact`.
    """
    sink = ParquetSink(zone)

    def job(name: str, build: Callable[[], DataFrame]) -> Callable[[], int]:
        if name == FACT and fact_by_month:
            return lambda: sink.write(clustered_by_month(build()), name, MONTH)
        return lambda: sink.write(in_report_order(name, build()), name)

    counts = in_parallel(zone.spark, [job(*table) for table in tables.items()], threads)
    return dict(zip(tables, counts))


FACT = "fact_order_items"


class SupersededError(RuntimeError):
    """A run that began later has been published."""


def _last_number(spark: SparkSession, folder: str) -> int:
    """The highest number that is taken in a folder, 0 if none is."""
    return max((int(name) for name in child_files(spark, folder) if name.isdigit()), default=0)


def begin_run(spark: SparkSession, target: str, run_id: str) -> int:
    """The number of a run that begins, above those of all runs before it."""
    folder = f"{target.rstrip('/')}/_started"
    while True:
        number = _last_number(spark, folder) + 1
        if put_if_absent(spark, f"{folder}/{number:012d}", run_id):
            return number


def last_commit(spark: SparkSession, target: str) -> tuple[int, int, str | None]:
    """Number of the last commit, number and id of its run; zeros if there is none."""
    folder = f"{target.rstrip('/')}/_commits"
    number = _last_number(spark, folder)
    if not number:
        return 0, 0, None
    begun, _, run_id = read_text(spark, f"{folder}/{number:012d}").partition(" ")
    return number, int(begun), run_id


def mark_published(
    spark: SparkSession, target: str, run_id: str, begun: int | None = None
) -> None:
    """Make a run the one that readers see.

    ``begun`` is its number from :func:`begin_run`; without, it counts as beginning now. Raises
    :class:`SupersededError` where a run that began later has been published.
    """
    if begun is None:
        begun = begin_run(spark, target, run_id)
    folder = f"{target.rstrip('/')}/_commits"
    while True:
        # The last commit is also the newest run, as none older can follow it.
        number, newest, other = last_commit(spark, target)
        if newest > begun:
            raise SupersededError(f"run {run_id} is older than {other}, which is published")
        # Another run may commit between the look and this: then the number is taken, look again.
        if put_if_absent(spark, f"{folder}/{number + 1:012d}", f"{begun} {run_id}"):
            return


def published_run(spark: SparkSession, target: str) -> str | None:
    """Id of the last published run."""
    return last_commit(spark, target)[2]


def publish(
    spark: SparkSession,
    tables: dict[str, DataFrame],
    target: str,
    run_id: str,
    threads: int = 4,
    fact_by_month: bool = False,
) -> dict[str, int]:
    """Write all tables of a run, then make it visible; row counts by table.

    Raises :class:`SupersededError` where a run that began later was faster.
    """
    begun = begin_run(spark, target, run_id)
    builders = {name: (lambda df=df: df) for name, df in tables.items()}
    counts = write_tables(run_zone(spark, target, run_id), builders, threads, fact_by_month)
    mark_published(spark, target, run_id, begun)
    return counts


def read_published(spark: SparkSession, target: str) -> dict[str, DataFrame]:
    """The warehouse tables of the last published run."""
    run_id = published_run(spark, target)
    if run_id is None:
        raise LookupError(f"nothing published under {target}")
    zone = run_zone(spark, target, run_id)
    # A fact in monthly folders has its month besides.
    return {name: zone.table(name).select(*cols) for name, cols in WAREHOUSE_COLUMNS.items()}


def published_fact(spark: SparkSession, target: str, days: DataFrame) -> DataFrame:
    """Published fact rows of the given days (rows of the published ``dim_date``).

    Where the fact is stored by month, folders of other months are not read.
    """
    run_id = published_run(spark, target)
    if run_id is None:
        raise LookupError(f"nothing published under {target}")
    fact = run_zone(spark, target, run_id).table(FACT)
    if MONTH not in fact.columns:
        fact = fact.withColumn(MONTH, month_number(F.col("order_date")))
    return fact_on_days(fact, days)


def register_views(spark: SparkSession, target: str) -> None:
    """Session views over the last published run, for SQL users."""
    for name, df in read_published(spark, target).items():
        df.createOrReplaceTempView(name)


def copy_to_database(spark: SparkSession, target: str, sink: JdbcSink) -> dict[str, int]:
    """Replace the database tables from the last published run, marts in report order, at once."""
    tables = read_published(spark, target)
    return sink.write_all({name: in_report_order(name, df) for name, df in tables.items()})


def expire_runs(spark: SparkSession, target: str, keep: int) -> list[str]:
    """Remove the folders of all but the newest ``keep`` runs; the removed ids.

    Run ids begin with their start time. The published run stays whatever its age, also where
    refreshes have stopped or failed since.
    """
    if keep < 0:
        raise ValueError("keep is negative")
    runs = sorted(child_folders(spark, f"{target.rstrip('/')}/_runs"))
    spared = {*runs[len(runs) - keep :], published_run(spark, target)}
    expired = [run_id for run_id in runs if run_id not in spared]
    for run_id in expired:
        delete_folder(spark, run_zone(spark, target, run_id).root)
    return expired
