"""CSV files to typed raw tables."""

from __future__ import annotations

import logging
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewind.functions.text import checked, null_if_token, typed_cell, whole_number
from tradewind.schemas import DEFAULT_MANIFEST, ORDINAL, RAW_TABLES, RawTable
from tradewind.session import in_parallel, path_exists
from tradewind.sources.records import whole_records

log = logging.getLogger(__name__)


def _guess_types(df: DataFrame, columns: list[str]) -> dict[str, T.DataType]:
    """Narrowest of bigint, double and string that reads every cell, in one pass."""
    if not columns:
        return {}
    tests: list[Column] = []
    for i, name in enumerate(columns):
        cell = F.col(name)
        tests += [
            F.count(cell).alias(f"n{i}"),
            F.count(whole_number(cell, T.LongType())).alias(f"long{i}"),
            F.count(cell.try_cast("double")).alias(f"double{i}"),
        ]
    found = df.agg(*tests).first()
    types: dict[str, T.DataType] = {}
    for i, name in enumerate(columns):
        filled = found[f"n{i}"]
        if filled and found[f"long{i}"] == filled:
            types[name] = T.LongType()
        elif filled and found[f"double{i}"] == filled:
            types[name] = T.DoubleType()
        else:
            types[name] = T.StringType()
    return types


def has_quoted_breaks(spark: SparkSession, path: str) -> bool:
    """Whether some line has an odd number of quotes, so that a record may go on past it.

    One more pass over the text, ended by the first such line.
    """
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    return not spark.read.text(path).filter(quotes % 2 == 1).isEmpty()


def has_bare_returns(spark: SparkSession, path: str) -> bool:
    """Whether a carriage return stands elsewhere than before a line feed."""
    lines = spark.read.option("lineSep", "\n").text(path)
    return not lines.filter(F.col("value").rlike("\r.")).isEmpty()


def largest_file(spark: SparkSession, path: str) -> int:
    """Bytes of the largest file; contents are not read."""
    files = spark.read.format("binaryFile").load(path)
    return files.agg(F.max("length")).first()[0] or 0


# Files with quoted line breaks over this size are read in ranges. Finding records in ranges costs
# about twenty times the CPU of reading on, which pays once a file keeps one task too long.
SPLIT_ABOVE = 1 << 30

# The position of a row in its file; the name is out of reach of a header cell.
_PLACE = "\x00place"


def _placed_cells(
    spark: SparkSession, path: str, multi_line: bool | None, split_above: int
) -> DataFrame:
    """All columns as text by header name, with the row's position in its file at the end."""
    options = {"escape": '"', "multiLine": True}
    if multi_line is None:
        multi_line = has_quoted_breaks(spark, path)
        if multi_line and largest_file(spark, path) > split_above:
            if not has_bare_returns(spark, path):
                return _cells_of_records(spark, path, options)
            log.warning(
                "%s has quoted line breaks and bare returns: each file is read by one task", path
            )
    # With enforceSchema off, files whose headers disagree are an error, not misread.
    text = spark.read.options(
        header=True, enforceSchema=False, **options | {"multiLine": multi_line}
    ).csv(path)
    place = F.struct(
        F.col("_metadata.file_name").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )
    return text.select("*", place.alias(_PLACE))


def _cells_of_records(spark: SparkSession, path: str, options: Mapping) -> DataFrame:
    """The cells of :func:`whole_records`. Files whose headers disagree are an error."""
    header = spark.read.options(header=False, **options).csv(path).first()
    names = spark.read.options(header=True, **options).csv(path).columns
    cells = ", ".join(f"`c{i}` string" for i in range(len(names)))
    text = F.regexp_replace("_text", "^\ufeff", "")
    parsed = whole_records(spark, path).select(
        "_name",
        "_record",
        F.from_csv(
            F.when(F.col("_record") == 1, text).otherwise(F.col("_text")),
            cells,
            {name: str(value).lower() for name, value in options.items()},
        ).alias("_cells"),
    )
    row = F.array(*[F.col(f"_cells.c{i}") for i in range(len(names))])
    want = F.array(*[F.lit(cell).cast("string") for cell in header])
    message = F.concat(F.lit("header differs: "), F.col("_name"))
    is_header = F.when(F.col("_record") > 1, False).otherwise(
        F.when(row == want, True).otherwise(F.raise_error(message).cast("boolean"))
    )
    place = F.struct(
        F.col("_name").alias("file"), F.lit(0).cast("long").alias("block"), F.col("_record").alias("row")
    )
    return parsed.filter(~is_header).select(
        *[F.col(f"_cells.c{i}").alias(name) for i, name in enumerate(names)], place.alias(_PLACE)
    )


def read_csv(
    spark: SparkSession,
    path: str,
    table: RawTable,
    *,
    infer_undeclared: bool = False,
    multi_line: bool | None = None,
    split_above: int = SPLIT_ABOVE,
    on_bad_cells: str = "fail",
    bad_cells: Observation | None = None,
) -> DataFrame:
    """A CSV file with a header row as a typed table.

    Columns are found by header name. Declared ones get their declared type. A cell that does
    not fit it without loss (words, out of range, digits beyond the scale, a fraction in an
    integer) fails the action that reads it; with ``on_bad_cells="count"`` it becomes null, and
    ``bad_cells`` observes how many of each column did. Other columns pass through as text, or
    with ``infer_undeclared`` as the type that one extra pass over them finds.

    By default a pass over the text finds whether quoted cells may hold line breaks. If so, each file
    is read by one task, but where one is larger than ``split_above`` bytes, records are found
    in byte ranges by many (:mod:`tradewind.sources.records`), unless there are carriage
    returns without line feed. Both give the same rows. ``multi_line`` true or false spares the pass
    and reads by one task a file, or by lines.
    """
    text = _placed_cells(spark, path, multi_line, split_above)
    names = text.columns[:-1]
    declared = {field.name: field.dataType for field in table.schema}
    missing = [name for name in declared if name not in names]
    if missing:
        raise ValueError(f"{path}: no column named {', '.join(missing)}")

    cells = text.withColumns({name: null_if_token(F.col(f"`{name}`")) for name in names})
    types = dict(declared)
    if infer_undeclared:
        types |= _guess_types(cells, [c for c in names if c not in declared])
    typed = {
        name: typed_cell(F.col(f"`{name}`"), types.get(name, T.StringType()))
        for name in names
    }
    columns = [
        checked(F.col(f"`{name}`"), value, name, on_bad_cells).alias(name)
        for name, value in typed.items()
    ]
    if table.keeps_order:
        columns.append(F.col(f"`{_PLACE}`").alias(ORDINAL))
    if bad_cells is None:
        return cells.select(*columns)
    lost = {n: v for n, v in typed.items() if not isinstance(types.get(n), T.StringType | None)}
    if not lost:
        return cells.select(*columns)
    flags = [
        (F.col(f"`{name}`").isNotNull() & value.isNull()).alias(f"_bad_{i}")
        for i, (name, value) in enumerate(lost.items())
    ]
    counts = [F.count_if(F.col(f"_bad_{i}")).alias(name) for i, name in enumerate(lost)]
    flagged = cells.select(*columns, *flags).observe(bad_cells, *counts)
    return flagged.drop(*[f"_bad_{i}" for i in range(len(lost))])


class Ingested(dict[str, int]):
    """Row counts by table; ``bad_cells`` counts the cells set to null, by table and column."""

    def __init__(self, rows: Mapping[str, int], bad_cells: Mapping[tuple[str, str], int]):
        super().__init__(rows)
        self.bad_cells = dict(bad_cells)


def ingest(
    spark: SparkSession,
    folder: str,
    sink,
    manifest: Mapping[str, str] = DEFAULT_MANIFEST,
    *,
    on_missing: str = "skip",
    on_bad_cells: str = "fail",
    threads: int = 4,
    **options,
) -> Ingested:
    """Load every file of the manifest into its raw table, side by side.

    A table that is not declared comes in with inferred types. A missing file is skipped with a
    warning, or raises with ``on_missing="fail"``.
    """
    present = {}
    for filename, name in manifest.items():
        path = f"{folder.rstrip('/')}/{filename}"
        if path_exists(spark, path):
            present[name] = path
        elif on_missing == "fail":
            raise FileNotFoundError(path)
        else:
            log.warning("%s not found, skipped", path)

    def load(name: str, path: str) -> tuple[int, dict[str, int]]:
        declared = RAW_TABLES.get(name)
        seen = Observation() if on_bad_cells == "count" and declared else None
        settings = {"infer_undeclared": declared is None} | options
        table = declared or RawTable(T.StructType())
        df = read_csv(
            spark, path, table, on_bad_cells=on_bad_cells, bad_cells=seen, **settings
        )
        rows = sink.write(df, name)
        numeric = declared and any(not isinstance(f.dataType, T.StringType) for f in table.schema)
        found = {c: n for c, n in seen.get.items() if n} if seen and numeric else {}
        log.info("%s: %d rows from %s; bad cells: %s", name, rows, path, found or "none")
        return rows, found

    jobs = [lambda n=n, p=p: load(n, p) for n, p in present.items()]
    loaded = dict(zip(present, in_parallel(spark, jobs, threads)))
    return Ingested(
        {name: rows for name, (rows, _) in loaded.items()},
        {(name, c): n for name, (_, found) in loaded.items() for c, n in found.items()},
    )
