"""The batch job: extract, transform, publish, report.

    spark-submit run_refresh.py --raw <folder> --target <folder>

Schedule it with whatever runs the cluster's jobs; every run is a full refresh.
"""

from __future__ import annotations

import argparse
import logging
import sys
import traceback
import uuid
from collections.abc import Callable
from contextlib import nullcontext
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.operators.clean import clean_orders
from tradewind.plans import marts, rollups, star
from tradewind.plans.master import master
from tradewind.plans.warehouse import count_duplicates
from tradewind.quality import check_keys
from tradewind.schemas import DEFAULT_MANIFEST, RAW_TABLES
from tradewind.session import configure, drop_scratch, fit_shuffles, in_parallel, scratch_dir
from tradewind.sinks.buckets import lay_out
from tradewind.sinks.publish import (
    begin_run,
    copy_to_database,
    expire_runs,
    mark_published,
    run_zone,
    write_tables,
)
from tradewind.sinks.tables import JdbcSink, ParquetSink
from tradewind.sources.csv import Ingested, ingest
from tradewind.sources.extract import Source, bad_money, extract
from tradewind.sources.tables import CatalogZone, JdbcZone, LoadZone, ParquetZone

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class Config:
    """Settings of a run.

    ``land_inputs`` copies the inputs to the shared scratch folder first, so that a
    database is read once, as of one moment where it can, instead of once per output table.
    ``threads`` bounds the tables
    written at the same time. With ``check_warehouse`` the grain of the fact and its orphan
    keys are counted in the stored tables. ``fact_by_month`` stores the fact in monthly folders.
    ``on_bad_cells`` says what an amount does that is no
    decimal of four digits: "fail" the run, or become null and be "count"-ed in the report.
    """

    target: str
    land_inputs: bool = False
    threads: int = 4
    check_warehouse: bool = True
    on_bad_cells: str = "fail"
    fact_by_month: bool = False


@dataclass
class RunReport:
    """What a run did."""

    run_id: str
    started: datetime
    finished: datetime | None = None
    status: str = "running"
    error: str | None = None
    rows: dict[str, int] = field(default_factory=dict)
    violations: dict[str, int] = field(default_factory=dict)

    @property
    def succeeded(self) -> bool:
        return self.status == "succeeded"

    def checks_df(self, spark: SparkSession) -> DataFrame:
        """One row per check with the number of violations."""
        rows = [(self.run_id, name, n) for name, n in self.violations.items()]
        return spark.createDataFrame(rows, "run_id string, check_name string, violations bigint")

    def to_df(self, spark: SparkSession) -> DataFrame:
        """One row per table, or a single row without a table for a failed run."""
        head = (self.run_id, self.started, self.finished, self.status, self.error)
        rows = [head + item for item in self.rows.items()] or [head + (None, None)]
        return spark.createDataFrame(
            rows,
            "run_id string, started timestamp, finished timestamp, status string, error string,"
            " table_name string, row_count bigint",
        )


def _now() -> datetime:
    return datetime.now(timezone.utc)


def _stage(sink: ParquetSink, df: DataFrame, name: str) -> DataFrame:
    """Materialise a shared intermediate result where any executor can read it again."""
    sink.write(df, name)
    return sink.zone.table(name)


def build(
    spark: SparkSession, source: Source, zone: ParquetZone, scratch: str, config: Config
) -> tuple[dict[str, int], dict[str, int]]:
    """Write the eight tables of a run to its zone; row counts by table, and violations found.

    Item rows are shuffled once: their lines, still in decimals, are staged, and the fact and
    top_products read them. The other marts read the staged order totals.
    """
    staging = ParquetSink(ParquetZone(spark, scratch))
    violations = {}
    frozen = getattr(source, "frozen", None)
    # What is not landed is read again later, when a snapshot would be gone.
    with frozen(*RAW_TABLES) if frozen and config.land_inputs else nullcontext(source) as source:
        if config.on_bad_cells == "count":
            for table in ("raw_order_items", "raw_order_payments"):
                found = bad_money(source.table(table))
                violations |= {f"bad cells {table}.{column}": n for column, n in found.items()}
        data = extract(source, config.on_bad_cells)
        if config.land_inputs:
            jobs = [lambda n=n, df=df: _stage(staging, df, f"input_{n}") for n, df in data.items()]
            data = dict(zip(data, in_parallel(spark, jobs, config.threads)))

    # Plain tables only: Catalyst estimates a join by multiplying its sides.
    fit_shuffles(spark, data["orders"], data["order_items"], data["payments"])
    orders = clean_orders(data["orders"])
    customers, items = data["customers"], data["order_items"]
    products, payments = data["products"], data["payments"]
    duplicates = count_duplicates(
        orders=(orders, "order_id"),
        customers=(customers, "customer_id"),
        products=(products, "product_id"),
    )
    violations |= {f"duplicate {name}": n for name, n in duplicates.items()}
    # Each of the three chains below writes on its own threads.
    threads = max(1, config.threads // 3)

    def write(**tables: Callable[[], DataFrame]) -> dict[str, int]:
        return write_tables(zone, tables, threads, config.fact_by_month)

    def lines() -> DataFrame:
        return _stage(staging, star.item_lines(items, orders, products), "lines")

    def fact() -> dict[str, int]:
        return write(fact_order_items=lambda: star.delivered_money(lines()))

    def fact_and_products() -> dict[str, int]:
        stored = lines()
        sold = stored.filter(F.col("order_status").isNotNull())
        return write(
            fact_order_items=lambda: star.delivered_money(stored),
            top_products=lambda: marts.top_products(sold),
        )

    def marts_from_totals() -> dict[str, int]:
        totals = _stage(staging, rollups.order_totals(orders, items, payments), "order_totals")
        return write(
            daily_revenue=lambda: rollups.daily_revenue(totals),
            customer_summary=lambda: rollups.customer_summary(totals, customers),
            delivery_performance=lambda: marts.delivery_performance(totals, customers),
            dim_date=lambda: star.dim_date(totals),
        )

    def marts_from_master() -> dict[str, int]:
        wide = master(orders, customers, items, products, payments).select(
            "order_id", "order_date", *marts.CUSTOMER_KEYS, *marts.PRODUCT_KEYS,
            "order_item_id", "price", "revenue", "payment_value",
        )
        wide = _stage(staging, wide, "master")
        return write(
            daily_revenue=lambda: marts.daily_revenue(wide),
            top_products=lambda: marts.top_products(wide),
            customer_summary=lambda: marts.customer_summary(wide),
            delivery_performance=lambda: marts.delivery_performance(orders, customers),
            dim_date=lambda: star.dim_date(orders),
        )

    def dimensions() -> dict[str, int]:
        return write(
            dim_customers=lambda: star.dim_customers(customers),
            dim_products=lambda: star.dim_products(products),
        )

    if not any(duplicates.values()):
        chains = [fact_and_products, marts_from_totals, dimensions]
    else:
        log.warning("duplicate keys (%s): marts come from the master table", duplicates)
        chains = [fact, marts_from_master, dimensions]
    rows = in_parallel(spark, chains, min(len(chains), config.threads))
    return {name: count for written in rows for name, count in written.items()}, violations


def run(spark: SparkSession, source: Source, config: Config) -> RunReport:
    """One full refresh. A failure is reported, not raised; the last good run stays visible.

    Runs may overlap: one that ends after a run that began later fails as superseded.
    """
    configure(spark)
    started = _now()
    report = RunReport(f"{started:%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:8]}", started)
    log.info("run %s started", report.run_id)
    scratch = None
    try:
        scratch = scratch_dir(spark, "run")
        begun = begin_run(spark, config.target, report.run_id)
        zone = run_zone(spark, config.target, report.run_id)
        report.rows, report.violations = build(spark, source, zone, scratch, config)
        if config.check_warehouse:
            stored = {name: zone.table(name) for name in report.rows}
            # The other tables come from a grouping by their grain.
            found = check_keys(stored, grains=("fact_order_items",)).collect()
            report.violations |= {row["check_name"]: row["violations"] for row in found}
        mark_published(spark, config.target, report.run_id, begun)
        report.status = "succeeded"
    except Exception as error:
        log.error("run %s failed\n%s", report.run_id, traceback.format_exc())
        report.status, report.error, report.rows = "failed", str(error), {}
    finally:
        if scratch:
            drop_scratch(spark, scratch)
    report.finished = _now()
    try:
        root = config.target.rstrip("/")
        report.to_df(spark).write.mode("append").parquet(f"{root}/_reports")
        if report.violations:
            report.checks_df(spark).write.mode("append").parquet(f"{root}/_checks")
    except Exception:
        log.error("report of run %s not stored\n%s", report.run_id, traceback.format_exc())
    log.info("run %s %s: %s", report.run_id, report.status, report.rows)
    return report


def _source(spark: SparkSession, args: argparse.Namespace) -> Source:
    if args.jdbc_url:
        return JdbcZone(spark, args.jdbc_url)
    if args.database:
        return CatalogZone(spark, args.database)
    loads = LoadZone(spark, args.raw)
    return loads if loads.exists() else ParquetZone(spark, args.raw)


def _manifest(args: argparse.Namespace) -> dict[str, str]:
    """File to table, from repeated ``--file name=table``, else the default list."""
    if not args.file:
        return DEFAULT_MANIFEST
    pairs = [entry.rpartition("=") for entry in args.file]
    if not all(name and table for name, _, table in pairs):
        raise ValueError("--file takes <file name>=<table>")
    return {name: table for name, _, table in pairs}


def load_csv(spark: SparkSession, folder: str, root: str, **options) -> Ingested:
    """Load CSV files as a new load of raw tables, seen by readers when all are complete."""
    zone = LoadZone(spark, root)
    load_id = f"{_now():%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:8]}"
    counts = ingest(spark, folder, ParquetSink(zone.folder(load_id)), **options)
    zone.enter(load_id, counts)
    return counts


def arguments() -> argparse.ArgumentParser:
    """The command line."""
    parser = argparse.ArgumentParser(description="Refresh the order warehouse.")
    parser.add_argument("--raw", help="folder of the raw tables")
    parser.add_argument("--csv", help="folder of CSV files to load into --raw first")
    parser.add_argument(
        "--file", action="append", help="<file name>=<table> to load, repeatable"
    )
    parser.add_argument("--database", help="catalog database of the raw tables")
    parser.add_argument(
        "--lay-out", metavar="DATABASE",
        help="copy the raw tables to this catalog database first, in buckets of order_id",
    )
    parser.add_argument("--jdbc-url", help="database of the raw tables")
    parser.add_argument("--target", required=True, help="warehouse folder")
    parser.add_argument(
        "--fact-by-month", action="store_true", help="store the fact in monthly folders"
    )
    parser.add_argument("--target-jdbc-url", help="database to copy the published tables to")
    parser.add_argument("--keep-runs", type=int, help="remove all older runs but the published")
    parser.add_argument(
        "--on-bad-cells", choices=("fail", "count"), default="fail",
        help="cells that do not fit their type: fail, or become null and be counted",
    )
    return parser


def main(argv: list[str] | None = None) -> int:
    """Command line entry; the exit code is 1 when the run failed."""
    parser = arguments()
    args = parser.parse_args(argv)
    if not (args.raw or args.database or args.jdbc_url):
        parser.error("one of --raw, --database and --jdbc-url is needed")
    if args.csv and not args.raw:
        parser.error("--csv needs --raw")

    logging.basicConfig(level=logging.INFO)
    spark = configure(SparkSession.builder.appName("tradewind-refresh").getOrCreate())
    if args.csv:
        load_csv(
            spark, args.csv, args.raw, manifest=_manifest(args), on_bad_cells=args.on_bad_cells
        )
    config = Config(
        args.target,
        land_inputs=bool(args.jdbc_url),
        on_bad_cells=args.on_bad_cells,
        fact_by_month=args.fact_by_month,
    )
    source = _source(spark, args)
    if args.lay_out:
        lay_out(spark, {name: source.table(name) for name in RAW_TABLES}, args.lay_out)
        source = CatalogZone(spark, args.lay_out)
    if not run(spark, source, config).succeeded:
        return 1
    if args.target_jdbc_url:
        copy_to_database(spark, args.target, JdbcSink(JdbcZone(spark, args.target_jdbc_url)))
    if args.keep_runs is not None:
        expire_runs(spark, args.target, args.keep_runs)
    return 0


if __name__ == "__main__":
    sys.exit(main())
