"""Benchmark decontamination with one Aho-Corasick automaton over words."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm.rows import stored

# After lower-casing A-Z: digits, a-z and everything beyond ASCII.
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {upper: upper + 32 for upper in range(ord("A"), ord("Z") + 1)}
WINDOW = 10
# Words of one automaton; a larger benchmark is scanned for in several passes.
BLOCK_WORDS = 100_000

HITS = "n_words long, spans array<struct<start:int,end:int,first:int,last:int>>, items array<string>"


def ascii_lower(text: str) -> str:
    """A-Z lower-cased, all else as it is."""
    if text.isascii():
        return text.lower()
    return text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")


def words_of(text: str) -> list[str]:
    return WORD.findall(ascii_lower(text))


def windows_of(words: list[str], length: int = WINDOW) -> list[tuple[str, ...]]:
    """All windows of an item; an item shorter than a window is one window."""
    if not words:
        return []
    return [tuple(words[i : i + length]) for i in range(max(1, len(words) - length + 1))]


def build(items: list[tuple[str, str]]) -> tuple[dict[str, int], object, list[list[str]]]:
    """Word numbers, automaton over word numbers, and the items of each pattern."""
    numbers: dict[str, int] = {}
    patterns: dict[tuple[int, ...], list[str]] = {}
    for item, text in items:
        for window in set(windows_of(words_of(text))):
            key = tuple(numbers.setdefault(word, len(numbers) + 1) for word in window)
            patterns.setdefault(key, []).append(item)
    automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
    lengths = []
    for i, key in enumerate(patterns):
        automaton.add_word(key, i)
        lengths.append(len(key))
    automaton.make_automaton()
    return numbers, automaton, list(zip(patterns.values(), lengths, strict=True))


def scan(text: str, numbers: dict, automaton, patterns: list) -> tuple[int, list, list]:
    """Number of words, hit spans and items of one text.

    A span has code point offsets into the original text and the numbers of its first and last
    word; spans neither overlap nor touch. The text is scanned once.
    """
    lowered = ascii_lower(text)
    words = WORD.findall(lowered)
    if not patterns or not words:
        return len(words), [], []
    known = numbers.get
    found: list[tuple[int, int]] = []
    items: set[str] = set()
    for last, pattern in automaton.iter(tuple([known(word, 0) for word in words])):
        names, length = patterns[pattern]
        items.update(names)
        found.append((last - length + 1, last))
    if not found:
        return len(words), [], []
    runs: list[list[int]] = []
    for first, last in sorted(found):
        if runs and first <= runs[-1][1] + 1:
            runs[-1][1] = max(runs[-1][1], last)
        else:
            runs.append([first, last])
    # Lower-casing A-Z keeps offsets, so those of the lowered text are the original's.
    places = [m.span() for m in WORD.finditer(lowered)]
    spans = [(places[a][0], places[b][1], a, b) for a, b in runs]
    return len(words), spans, sorted(items)


def _scanner(built):
    """Scans texts with a broadcast automaton; workers unpack it once and keep it."""

    def run(texts: pd.Series) -> pd.DataFrame:
        parts = built.value
        return pd.DataFrame(
            [scan(text, *parts) for text in texts], columns=["n_words", "spans", "items"]
        )

    return F.pandas_udf(run, HITS)


def _blocks(benchmark: DataFrame, block_words: int) -> Iterator[list[tuple[str, str]]]:
    """Different items in blocks of bounded size, read from the stored table block by block.

    Repeated rows count once. Items are dealt to buckets by hash, finer until no bucket of several
    items is over the bound; sizes are measured before a block is collected. So a block, whose automaton is
    broadcast, holds at most ``block_words`` words, or one item.
    """
    sized = stored(
        benchmark.select(
            F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"),
            F.coalesce("text", F.lit("")).alias("text"),
        )
        .distinct()
        .withColumn("chars", F.length("text") + 2),
        "benchmark",
    )
    # A word and its separator take two characters at least.
    bound = 2 * block_words
    total = sized.agg(F.sum("chars")).first()[0] or 0
    cuts, sizes = max(1, -(-total // bound)), []
    while True:
        bucket = F.pmod(F.xxhash64("item", "text"), F.lit(cuts)).alias("bucket")
        rows = sized.groupBy(bucket).agg(F.sum("chars").alias("chars"), F.count("*").alias("n"))
        sizes = sorted(tuple(r) for r in rows.collect())
        if all(chars <= bound or n == 1 for _, chars, n in sizes):
            break
        cuts *= 2
    if not sizes:
        yield []
    block: list[int] = []
    held = 0
    for at, chars, _ in [*sizes, (None, math.inf, 0)]:
        if block and held + chars > bound:
            part = sized.select("item", "text", bucket).filter(F.col("bucket").isin(block))
            yield [tuple(row) for row in part.select("item", "text").collect()]
            block, held = [], 0
        block.append(at)
        held += chars


def scanned(docs: DataFrame, benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``docs`` with ``__words`` (count), ``__spans`` and ``__items``.

    ``__spans`` are the merged runs of hit words: code point offsets ``start``, ``end`` (end
    exclusive) into the original text, and numbers of the ``first`` and ``last`` word.
    ``__items`` are the distinct items with an occurring window, as sorted strings.

    A null or empty text, of a document or an item, has no words and no hits. An item without
    id is named by the empty string. Items that share an id count as one. Repeated rows stay.
    Very long texts are scanned whole. Columns other than the three that are added may have any
    names but ``__found``, other than text any use. Benchmarks over ``block_words`` words take one pass per
    block, each writing the table before the next; smaller ones add nothing but a projection.
    """
    out = docs
    context = docs.sparkSession.sparkContext
    spans = "array<struct<start:int,end:int,first:int,last:int>>"
    for i, items in enumerate(_blocks(benchmark, block_words)):
        found = _scanner(context.broadcast(build(items)))
        if i:
            out = stored(out, "decontaminated")
        else:
            out = out.withColumns(
                {
                    "__words": F.lit(None).cast("long"),
                    "__spans": F.array().cast(spans),
                    "__items": F.array().cast("array<string>"),
                }
            )
        out = (
            out.withColumn("__found", found(F.coalesce("text", F.lit(""))))
            .withColumns(
                {
                    "__words": F.col("__found.n_words"),
                    "__spans": merged_spans(F.concat("__spans", "__found.spans"))
                    if i
                    else F.col("__found.spans"),
                    "__items": F.array_sort(F.array_union("__items", "__found.items"))
                    if i
                    else F.col("__found.items"),
                }
            )
            .drop("__found")
        )
    return out


def merged_spans(spans):
    """Spans of several blocks, merged where they overlap or touch."""
    empty = F.array().cast("array<struct<start:int,end:int,first:int,last:int>>")

    def add(done, span):
        last = F.element_at(done, -1)
        joined = F.struct(
            last["start"].alias("start"),
            F.greatest(last["end"], span["end"]).alias("end"),
            last["first"].alias("first"),
            F.greatest(last["last"], span["last"]).alias("last"),
        )
        touches = (F.size(done) > 0) & (span["first"] <= last["last"] + 1)
        return F.when(
            touches, F.concat(F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))), F.array(joined))
        ).otherwise(F.concat(done, F.array(span)))

    return F.aggregate(F.array_sort(spans), empty, add)


def hit_words(spans: str = "__spans"):
    """Number of words inside the spans."""
    return F.aggregate(
        F.col(spans), F.lit(0).cast("long"), lambda n, s: n + s["last"] - s["first"] + 1
    )


def clean_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that no benchmark window occurs in; columns as in ``docs``."""
    return (
        scanned(docs, benchmark)
        .filter(F.size("__items") == 0)
        .select(*[f"`{c}`" for c in docs.columns])
    )
