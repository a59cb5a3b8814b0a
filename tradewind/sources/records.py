"""CSV records that go on past a line break, read from byte ranges by many tasks.

A task sees the lines of its range but not whether the range begins inside a quoted cell. So
each line is turned into what it does to that state: whether a quoted cell is open behind
it, should one be open before it or not. These effects are composed along a range and then along
the ranges of a file, as a prefix sum composes numbers. With the state in front of every range known,
records begin at the lines that no quoted cell reaches into, wherever ranges are cut.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tradewind.session import scratch_dir

# Task functions travel with their code, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

RANGE = ("_file", "_block")


# Stands for a quote at the beginning of a cell, with the comma before it.
OPENING = "\x01"


def _quotes(line: Column) -> Column:
    """The quotes of a line that matter: ``OPENING`` where a cell begins, else the quote.

    Two quotes in a row are either an escape or an empty cell, and in cells that are not quoted they
    are plain text: none of it changes whether a cell is open.
    """
    single = F.replace(F.translate(line, OPENING, " "), F.lit('""'), F.lit(""))
    marked = F.replace(F.concat(F.lit(","), single), F.lit(',"'), F.lit(OPENING))
    return F.regexp_replace(marked, f'[^{OPENING}"]+', "")


def _left_open(quotes: Column) -> Column:
    """Whether a quoted cell is open behind such quotes, if none is before them.

    From the left, an opening quote and whichever follows make a cell; others are plain text.
    """
    return F.contains(F.regexp_replace(quotes, f'{OPENING}["{OPENING}]', ""), F.lit(OPENING))


def physical_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines as the file has them, with file, byte range, position in it, and effect.

    ``_from_out`` and ``_from_in`` say whether a quoted cell is open behind the line if none, or
    one, is open before it.
    """
    lines = spark.read.option("lineSep", "\n").text(path)
    quotes = F.col("_quotes")
    return lines.select(
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_at"),
        F.col("value").alias("_line"),
        F.when(F.contains("value", F.lit('"')), _quotes(F.col("value"))).otherwise("").alias(
            "_quotes"
        ),
    ).select(
        "_file",
        "_block",
        "_at",
        "_line",
        ((quotes != "") & _left_open(quotes)).alias("_from_out"),
        # The first quote closes the cell that was open.
        ((quotes == "") | _left_open(F.substr(quotes, F.lit(2)))).alias("_from_in"),
    )


def _composed(df: DataFrame, partition: tuple[str, ...], order: str) -> DataFrame:
    """The effect of all rows before each, composed: ``_sure`` with the state ``_state`` where some
    effect does not depend on the start, else ``_state`` says whether the start is turned round.

    Rows carry effects as ``_from_out`` and ``_from_in``. One that sends both to the same state
    makes the state known; one that exchanges them turns it round.
    """
    turns = (F.col("_from_out") & ~F.col("_from_in")).cast("long")
    fixed = F.col("_from_out") == F.col("_from_in")
    along = Window.partitionBy(*partition).orderBy(order)
    so_far = along.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    last = F.last(
        F.when(fixed, F.struct(F.col("_from_out").cast("long").alias("state"), "_turned")),
        ignorenulls=True,
    ).over(before)
    turned = F.col("_turned") - turns
    return (
        df.withColumn("_turned", F.sum(turns).over(so_far))
        .withColumn("_last", last)
        .withColumn("_sure", F.col("_last").isNotNull())
        .withColumn(
            "_state",
            F.when(F.col("_sure"), F.col("_last.state") + turned - F.col("_last._turned"))
            .otherwise(turned) % 2 == 1,
        )
        .drop("_turned", "_last")
    )


def _is_blank() -> Column:
    return F.col("_line").isin("", "\r")


def _ranges(lines: DataFrame) -> DataFrame:
    """State in front of each byte range, and the number of records that begin before it.

    A range becomes one row before the ranges of a file meet; texts are not shuffled.
    """
    narrow = lines.select(*RANGE, "_at", "_from_out", "_from_in", _is_blank().alias("_blank"))
    inside = _composed(narrow, RANGE, "_at")
    starts = lambda sure, state: F.count_if(
        (F.col("_sure") == sure) & (F.col("_state") == state) & ~F.col("_blank")
    )

    def behind_line(open_before: Column) -> Column:
        return F.when(open_before, F.col("_from_in")).otherwise(F.col("_from_out"))

    # In front of a line, the state is _state itself for a range that begins outside; for one that
    # begins inside it is that too where it is sure, else the other.
    behind_out = behind_line(F.col("_state"))
    behind_in = behind_line(F.col("_sure") == F.col("_state"))
    behind = inside.groupBy(*RANGE).agg(
        F.max_by(F.struct(behind_out.alias("out"), behind_in.alias("in")), "_at").alias("_behind"),
        starts(True, False).alias("_sure_starts"),
        starts(False, False).alias("_out_starts"),
        starts(False, True).alias("_in_starts"),
    )
    effects = behind.select(
        "*",
        F.col("_behind.out").alias("_from_out"),
        F.col("_behind.in").alias("_from_in"),
    ).drop("_behind")
    # A file begins outside; so does whatever "turned round" starts from.
    placed = _composed(effects, ("_file",), "_block")
    own = F.col("_sure_starts") + F.when(F.col("_state"), F.col("_in_starts")).otherwise(
        F.col("_out_starts")
    )
    along = Window.partitionBy("_file").orderBy("_block")
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    ends_open = F.when(F.col("_state"), F.col("_from_in")).otherwise(F.col("_from_out"))
    return placed.select(
        F.col("_file").alias("_range_file"),
        F.url_decode(F.substring_index("_file", "/", -1)).alias("_name"),
        F.col("_block").alias("_range_block"),
        F.col("_state").alias("_range_state"),
        F.coalesce(F.sum(own).over(before), F.lit(0)).alias("_range_starts"),
        (F.col("_state") | ends_open).alias("_range_cut"),
    )


RECORD = "_range long, _record long, _text string, _complete boolean"


def _states(state: bool, from_out: np.ndarray, from_in: np.ndarray) -> np.ndarray:
    """Whether a quoted cell is open behind each line, from the state before the first."""
    at = np.where(from_out == from_in, np.arange(len(from_out)), -1)
    last = np.maximum.accumulate(at)
    turned = np.cumsum(from_out & ~from_in)
    known = last >= 0
    base = np.where(known, from_out[last], state)
    return base ^ ((turned - np.where(known, turned[last], 0)) % 2 == 1)


class _Range:
    """One byte range while its lines go by: the state, the record, and the lines of an open one."""

    def __init__(self, number: int, state: bool, starts: int):
        self.number, self.state, self.record = number, state, starts
        # A record that reaches into the range is completed elsewhere.
        self.pending: list[str] = []
        self.reaches_in = state

    def add(self, lines: pa.Array, from_out: np.ndarray, from_in: np.ndarray) -> pa.RecordBatch:
        """The records that end within these lines."""
        behind = _states(self.state, from_out, from_in)
        before = np.r_[self.state, behind[:-1]]
        blank = pc.is_in(lines, pa.array(["", "\r"], lines.type)).to_numpy(zero_copy_only=False)
        begins = ~before & ~blank
        record = self.record + np.cumsum(begins)
        whole = np.flatnonzero(begins & ~behind)
        texts, numbers, complete = [], [], []
        broken = np.flatnonzero(before | begins & behind)
        parts = lines.take(pa.array(broken)).to_pylist()
        for at, line in zip(broken.tolist(), parts, strict=True):
            # As the reader of whole files does: a break within a cell is \n.
            self.pending.append(line.removesuffix("\r"))
            if not behind[at]:
                texts.append("\n".join(self.pending))
                numbers.append(int(record[at]))
                complete.append(not self.reaches_in)
                self.pending, self.reaches_in = [], False
        self.state, self.record = bool(behind[-1]), int(record[-1])
        done = self._batch(texts, numbers, complete)
        plain = self._batch(lines.take(pa.array(whole)), record[whole], np.ones(len(whole), bool))
        return [done, plain]

    def end(self) -> pa.RecordBatch:
        """The lines of the record that goes on in the next range, or ends the file."""
        texts = ["\n".join(self.pending)] if self.pending else []
        return self._batch(texts, [self.record] * len(texts), [False] * len(texts))

    def _batch(self, texts, numbers, complete) -> pa.RecordBatch:
        columns = [
            pa.array(np.full(len(numbers), self.number), pa.int64()),
            pa.array(numbers, pa.int64()),
            pa.array(texts, pa.string()) if isinstance(texts, list) else texts.cast(pa.string()),
            pa.array(complete, pa.bool_()),
        ]
        return pa.RecordBatch.from_arrays(columns, ["_range", "_record", "_text", "_complete"])


def _assembled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records of the ranges that a task reads, whose lines come in order."""
    now: _Range | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        column = dict(zip(batch.schema.names, batch.columns, strict=True))
        numbers = column["_range"].to_numpy()
        from_out = column["_from_out"].to_numpy(zero_copy_only=False)
        from_in = column["_from_in"].to_numpy(zero_copy_only=False)
        cuts = (np.flatnonzero(np.diff(numbers)) + 1).tolist()
        for first, last in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
            if now is None or now.number != numbers[first]:
                if now is not None:
                    yield now.end()
                state, starts = column["_range_state"][first], column["_range_starts"][first]
                now = _Range(int(numbers[first]), state.as_py(), starts.as_py())
            lines = column["_line"].slice(first, last - first)
            yield from now.add(lines, from_out[first:last], from_in[first:last])
    if now is not None:
        yield now.end()


def whole_records(spark: SparkSession, path: str) -> DataFrame:
    """Every record of the files as text: ``_file``, ``_name``, ``_record`` (from 1 in each file)
    and ``_text``. The header is a record too; blank lines between records are none. Breaks within
    cells are \\n, also where the file has \\r\\n. A quote that is never closed makes the rest of its file one record.

    One narrow pass, run at once, finds the state in front of each byte range. With it, every task puts the
    records of its ranges together as their lines go by; texts are not shuffled unless there are so
    many ranges that their states cannot be broadcast. Only the ends of records that
    reach over a cut, two texts a range at most, are grouped, from the ranges that have any.
    """
    lines = physical_lines(spark, path)
    # Stored, so that the numbers stay and the size is known when the joins are planned.
    folder = scratch_dir(spark, "csv-ranges")
    numbered = _ranges(lines).withColumn("_range", F.monotonically_increasing_id())
    numbered.write.parquet(f"{folder}/ranges")
    ranges = spark.read.parquet(f"{folder}/ranges")
    same = (F.col("_file") == F.col("_range_file")) & (F.col("_block") == F.col("_range_block"))

    def records(of: DataFrame) -> DataFrame:
        # A join that shuffles does not keep the lines in order.
        placed = lines.join(of, same).sortWithinPartitions("_range", "_at")
        return placed.select(
            "_range", "_line", "_from_out", "_from_in", "_range_state", "_range_starts"
        ).mapInArrow(_assembled, RECORD)

    of_range = ranges.select("_range", F.col("_range_file").alias("_file"), "_name", "_range_block")
    columns = ("_file", "_name", "_record")
    parts = F.sort_array(F.collect_list(F.struct("_range_block", "_text")))
    cut = (
        records(ranges.filter("_range_cut"))
        .filter("NOT _complete")
        .join(of_range, "_range")
        .groupBy(*columns)
        .agg(F.array_join(parts["_text"], "\n").alias("_text"))
    )
    whole = records(ranges).filter("_complete").join(of_range, "_range").select(*columns, "_text")
    # The file's line breaks may be \r\n.
    return whole.unionByName(cut).withColumn("_text", F.regexp_replace("_text", "\r$", ""))
