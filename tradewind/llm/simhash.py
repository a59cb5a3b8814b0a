"""SimHash near-duplicates, linked through tables of distances to pivot fingerprints."""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm.components import components
from tradewind.llm.rows import KEYS, multiplied, stored, with_row_key

SHINGLE_WORDS = 3
MAX_BITS = 3
SEED = 42
PIVOTS = 24
# Fingerprints of one block that one task compares; larger blocks are cut into cells.
BLOCK_ROWS = 1024
# Blocks up to this size are compared pair by pair, larger ones along a search.
SMALL_BLOCK = 8
CHUNK = 1 << 16


def fingerprint(text: str | None, shingle: int = SHINGLE_WORDS) -> int:
    """The 64-bit SimHash of a text as a signed long; 0 for a text without words."""
    # bytes.lower and bytes.split know ASCII only: A-Z, and \x20 \x09-\x0D.
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    ones = np.zeros(64, np.int64)
    for start in range(0, n, CHUNK):
        part = words[start : min(start + CHUNK, n) + shingle - 1]
        rows = zip(*(part[i:] for i in range(shingle)), strict=False) if n > 1 else [part]
        digests = [xxhash.xxh64_intdigest(b" ".join(row), SEED) for row in rows]
        octets = np.array(digests, "<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > n, bitorder="little")
    return int(bits.view("<i8")[0])


def pivots(n: int = PIVOTS) -> np.ndarray:
    """Reference fingerprints, made by rule."""
    return np.array([xxhash.xxh64_intdigest(b"pivot %d" % i, SEED) for i in range(n)], np.uint64)


def distance_table(prints: np.ndarray, references: np.ndarray) -> np.ndarray:
    """Hamming distances of all fingerprints to all pivots, one row per fingerprint."""
    return np.bitwise_count(prints[:, None] ^ references[None, :]).astype(np.int8)


def band_masks(max_bits: int) -> list[int]:
    """Masks of which at least one is untouched by any ``max_bits`` differing bits.

    The 64 bits are cut into ``max_bits + 2`` runs. Differences reach ``max_bits`` of them,
    so some two runs agree entirely.
    """
    runs = np.array_split(np.arange(64), max_bits + 2)
    signed = lambda mask: mask - (1 << 64) if mask >> 63 else mask
    return [
        signed(sum(1 << int(bit) for run in pair for bit in run))
        for pair in combinations(runs, 2)
    ]


def _search(prints: np.ndarray, table: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """A spanning forest of the links within one block.

    Rows are ordered by their distance to the first pivot, so only a narrow run of them can
    be near a given row. Of those, the other pivots discard all whose distances differ by
    more than ``max_bits`` somewhere; the rest are verified bit by bit.
    """
    order = np.argsort(table[:, 0], kind="stable")
    prints, table = prints[order], table[order]
    first = table[:, 0].astype(np.int64)
    low = np.searchsorted(first, first - max_bits)
    high = np.searchsorted(first, first + max_bits, side="right")
    waiting = np.ones(len(prints), bool)
    links = []
    for seed in range(len(prints)):
        if not waiting[seed]:
            continue
        waiting[seed] = False
        queue = deque([seed])
        while queue:
            at = queue.popleft()
            near = low[at] + np.flatnonzero(waiting[low[at] : high[at]])
            near = near[(np.abs(table[near] - table[at]) <= max_bits).all(axis=1)]
            near = near[np.bitwise_count(prints[near] ^ prints[at]) <= max_bits]
            waiting[near] = False
            queue.extend(near.tolist())
            links += [(int(order[at]), int(order[other])) for other in near]
    return links


def _links_of_blocks(
    prints: np.ndarray, starts: np.ndarray, references: np.ndarray, max_bits: int
) -> tuple[np.ndarray, np.ndarray]:
    """Links within blocks that lie one after the other, each beginning at one of ``starts``."""
    sizes = np.diff(np.append(starts, len(prints)))
    block = np.repeat(np.arange(len(starts)), sizes)
    size = np.repeat(sizes, sizes)
    table = np.zeros((len(prints), len(references)), np.int8)
    shared = np.flatnonzero(size > 1)
    table[shared] = distance_table(prints[shared], references)
    left, right = [], []
    for step in range(1, SMALL_BLOCK):
        a = np.flatnonzero((size[:-step] <= SMALL_BLOCK) & (block[:-step] == block[step:]))
        b = a + step
        close = (np.abs(table[a] - table[b]) <= max_bits).all(axis=1)
        a, b = a[close], b[close]
        close = np.bitwise_count(prints[a] ^ prints[b]) <= max_bits
        left.append(a[close])
        right.append(b[close])
    for at in np.flatnonzero(sizes > SMALL_BLOCK):
        own = slice(starts[at], starts[at] + sizes[at])
        links = _search(prints[own], table[own], max_bits)
        ends = np.array(links, np.int64).reshape(-1, 2) + starts[at]
        left.append(ends[:, 0])
        right.append(ends[:, 1])
    return np.concatenate(left), np.concatenate(right)


def _block_links(max_bits: int):
    """Task body: sorted rows (band, part, cell, fp) in, links out. Holds one batch and a block."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        references = pivots()
        carried = np.zeros((0, 4), np.int64)
        for batch in batches:
            rows = np.concatenate([carried, batch.to_numpy(np.int64)])
            if not len(rows):
                continue
            new = np.flatnonzero((rows[1:, :3] != rows[:-1, :3]).any(axis=1)) + 1
            starts = np.concatenate([[0], new])
            carried = rows[starts[-1] :]
            yield from links(rows[: starts[-1]], starts[:-1], references)
        if len(carried):
            yield from links(carried, np.array([0]), references)

    def links(rows, starts, references):
        if len(rows) < 2:
            return
        prints = np.ascontiguousarray(rows[:, 3]).view(np.uint64)
        a, b = _links_of_blocks(prints, starts, references, max_bits)
        yield pd.DataFrame({"a": rows[a, 3], "b": rows[b, 3]})

    return run


def print_links(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Links (a, b) that connect all distinct fingerprints at ``max_bits`` or fewer bits.

    Not every pair is listed, but each linked pair is connected through listed ones. Blocks
    of fingerprints that agree in two runs of bits are compared within a task. A block over
    ``BLOCK_ROWS`` is cut into parts by hash, and each pair of parts meets in a cell of its
    own, so no task takes a hot block whole and no pair is left out.
    """
    banded = prints.select(
        "fp",
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(i).alias("band"), F.col("fp").bitwiseAND(mask).alias("part"))
                    for i, mask in enumerate(band_masks(max_bits))
                ]
            )
        ).alias("key"),
    ).select("fp", "key.band", "key.part")
    hot = (
        banded.groupBy("band", "part")
        .count()
        .filter(F.col("count") > BLOCK_ROWS)
        .select("band", "part", F.ceil(F.col("count") / BLOCK_ROWS).alias("cuts"))
    )
    own = F.pmod(F.xxhash64("fp"), F.col("cuts"))
    met = F.explode(F.sequence(F.lit(0).cast("long"), F.col("cuts") - 1))
    celled = (
        banded.join(hot, ["band", "part"], "left")
        .withColumn("cuts", F.coalesce("cuts", F.lit(1).cast("long")))
        .select("band", "part", "fp", "cuts", own.alias("own"), met.alias("met"))
        .select(
            "band",
            "part",
            (F.least("own", "met") * F.col("cuts") + F.greatest("own", "met")).alias("cell"),
            "fp",
        )
    )
    return (
        celled.repartition("band", "part", "cell")
        .sortWithinPartitions("band", "part", "cell")
        .mapInPandas(_block_links(max_bits), "a long, b long")
    )


def near_duplicates(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    shingle: int = SHINGLE_WORDS,
    max_bits: int = MAX_BITS,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """One row per document: id, ``keep`` columns, ``fp`` (signed long), ``root``, ``component_id``.

    Documents whose fingerprints differ in at most ``max_bits`` bits are linked;
    ``component_id`` is the smallest id reachable, ``root`` one fingerprint of the component, which
    names it also where rows of several components share an id. Columns that are not kept do not
    matter, so none clashes; very long texts are read whole. A null or empty text has fingerprint 0 and
    is linked like any other. A null id never names a component that has another id. Repeated
    rows stay, each with the same result. An empty table gives an empty table.
    """

    def of_texts(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(text, shingle) for text in texts], dtype="int64")

    of_text = F.pandas_udf(of_texts, "long")
    # A null would reach pandas as a missing value; it counts as empty.
    text = F.coalesce(F.col(text_column), F.lit(""))
    printed = stored(
        docs.select(F.col(id_column).alias("__id"), *keep, of_text(text).alias("fp")), "prints"
    )
    unique = stored(printed.groupBy("fp").agg(F.min("__id").alias("least")), "unique")
    rooted = stored(components(print_links(unique.select("fp"), max_bits)), "rooted")
    members = stored(
        rooted.join(unique, rooted["node"] == unique["fp"]).select("fp", "root", "least"), "members"
    )
    roots = stored(members.groupBy("root").agg(F.min("least").alias("component_id")), "roots")
    named = members.join(roots, "root").select("fp", "root", "component_id")
    every = stored(
        unique.join(named, "fp", "left").select(
            "fp",
            F.coalesce("root", "fp").alias("root"),
            F.coalesce("component_id", "least").alias("component_id"),
        ),
        "classes",
    )
    return printed.join(every, "fp").select(
        F.col("__id").alias(id_column), *keep, "fp", "root", "component_id"
    )


def hex_print(fp: str = "fp"):
    """A signed fingerprint as 16 lower-case hex digits."""
    return F.lower(F.lpad(F.hex(F.col(fp)), 16, "0"))


def one_of_each(docs: DataFrame, **options) -> DataFrame:
    """The documents without near-duplicates: of each group the smallest id stays.

    Groups are told apart by their root fingerprint, not by an id, as rows that share an id
    may be in several. Of several rows with that id in a group, the one with the least content hash stays,
    and of equal rows one. Of a group without any id one row stays. Columns are those of
    ``docs``, whatever their names.
    """
    columns = docs.columns
    keyed = with_row_key(docs)
    found = near_duplicates(keyed, keep=KEYS, **options)
    id_column = options.get("id_column", "doc_id")
    chosen = (
        found.filter(F.col(id_column).eqNullSafe(F.col("component_id")))
        .groupBy("root")
        .agg(F.min(F.struct(*KEYS)).alias("__key"))
        .select("__key.*")
    )
    rows = found.groupBy(*KEYS).agg(F.count("*").alias("__rows"))
    counts = stored(chosen.join(rows, list(KEYS)).withColumn("__copies", F.lit(1)), "chosen")
    return multiplied(keyed, counts).select(*[f"`{c}`" for c in columns])
