"""Mixing sources to target weights by the cube method."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm.ranks import ranked
from tradewind.llm.rows import KEYS, multiplied, stored, with_row_key

WEIGHTS = (3, 1, 2)
BUDGET = 1.5
MOST_COPIES = 2
# Documents of one source that one task moves; what stays fractional goes on to the next level.
BUCKET_ROWS = 2_000
# Fractional documents of a source that the landing decides together.
LANDING = 14
SEED = 42
EPSILON = 1e-9


def word_count(text="text"):
    """Number of words between ASCII white space; 0 for null."""
    words = F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+"))
    return F.coalesce(words.cast("long"), F.lit(0).cast("long"))


def targets(
    sizes: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    budget: float = BUDGET,
    most: float = MOST_COPIES,
) -> DataFrame:
    """(source, source_size, target) from (source, source_size).

    Sources in code point order, null last, take the weights in turn and share ``budget`` times
    all sizes. A target stops at ``most`` times the source's size; the excess is shared anew by
    weight until none is above. Each round is one aggregation over the sources.
    """
    turn = F.element_at(
        F.array(*map(F.lit, weights)), (F.col("__rank") % len(weights) + 1).cast("int")
    )
    order = (F.col("source").isNull(), F.col("source"))
    weighted = ranked(sizes, *order).select(
        "source",
        "source_size",
        turn.cast("double").alias("weight"),
        (F.col("source_size") * float(most)).alias("cap"),
    )
    weighted = stored(weighted, "sources")
    total = budget * (weighted.agg(F.sum("source_size")).first()[0] or 0)
    rate = 0.0
    while True:
        above = F.col("cap") <= F.col("weight") * F.lit(rate)
        capped, free = weighted.agg(
            F.sum(F.when(above, F.col("cap"))), F.sum(F.when(~above, F.col("weight")))
        ).first()
        if not free or total <= 0:
            break
        following = (total - (capped or 0.0)) / free
        if following <= rate * (1 + 1e-15):
            break
        rate = following
    return weighted.select(
        "source", "source_size", F.least("cap", F.col("weight") * F.lit(rate)).alias("target")
    )


def _noise(key: tuple) -> float:
    """A number in [0, 1) that depends on nothing but the key."""
    return xxhash.xxh64_intdigest(repr(key).encode(), SEED) / 2.0**64


def flight(chance: np.ndarray, size: np.ndarray, key: tuple, spare: int = 0) -> np.ndarray:
    """Moves chances to 0 or 1 within the null space of two sums: documents and words.

    Three fractional documents at a time leave one direction in which neither the sum of the
    chances nor that of chance times size changes. A step along it, forward or back at odds
    that keep every expectation, takes one of the three to 0 or 1. At most two stay fractional,
    or up to ``spare``, where the flight ends with so many left.
    """
    chance = chance.astype(float).copy()
    held: list[int] = []
    waiting = np.flatnonzero((chance > EPSILON) & (chance < 1 - EPSILON)).tolist()
    for n, at in enumerate(waiting):
        if len(held) + len(waiting) - n <= spare:
            break
        held.append(at)
        while len(held) == 3:
            i, j, k = held
            # The null space of ((1, 1, 1), (size_i, size_j, size_k)).
            u = (
                float(size[j] - size[k]),
                float(size[k] - size[i]),
                float(size[i] - size[j]),
            )
            if not any(u):
                u = (1.0, -1.0, 0.0)
            ahead = back = math.inf
            for at_, step in zip(held, u, strict=True):
                if step > 0:
                    ahead = min(ahead, (1 - chance[at_]) / step)
                    back = min(back, chance[at_] / step)
                elif step < 0:
                    ahead = min(ahead, -chance[at_] / step)
                    back = min(back, -(1 - chance[at_]) / step)
            forward = _noise((*key, i, j, k)) * (ahead + back) < back
            move = ahead if forward else -back
            for at_, step in zip(held, u, strict=True):
                chance[at_] = min(1.0, max(0.0, chance[at_] + move * step))
            held = [x for x in held if EPSILON < chance[x] < 1 - EPSILON]
    return chance


def landing(chance: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Ends the last fractional documents of a source so that its words miss least.

    They are few, so all ways of rounding them are compared; ties go to the way that misses
    the number of documents less.
    """
    chance = chance.copy()
    open_ = np.flatnonzero((chance > EPSILON) & (chance < 1 - EPSILON))
    ways = (np.arange(1 << len(open_))[:, None] >> np.arange(len(open_))) & 1
    words = np.abs(ways @ size[open_] - float((chance[open_] * size[open_]).sum()))
    documents = np.abs(ways.sum(axis=1) - chance[open_].sum())
    chance[open_] = ways[np.lexsort((documents, np.round(words, 6)))[0]]
    return np.round(chance)


UNIT = "source string, size long, ua long, ub long, un long, chance double"
UNIT_NAMES = [part.split()[0] for part in UNIT.split(", ")]


def _move(level: int):
    """Task body: one bucket of one source's units through the flight, or the landing too."""

    def run(units: pd.DataFrame) -> pd.DataFrame:
        units, last = units.sort_values(["ua", "ub", "un"], kind="stable"), units["last"].iloc[0]
        size = units["size"].to_numpy()
        key = (level, int(units["ua"].iloc[0]), int(units["ub"].iloc[0]), len(units))
        moved = flight(units["chance"].to_numpy(), size, key, LANDING if last else 0)
        units["chance"] = landing(moved, size) if last else moved
        return units[UNIT_NAMES]

    return run


def dealt(units: DataFrame, level: int, bucket_rows: int = BUCKET_ROWS) -> tuple[DataFrame, int]:
    """Units with their ``bucket`` and whether it is the ``last`` of its source, and the most
    buckets that a source has.

    Each source is cut by its own count, so a small source beside a large one stays one bucket.
    The counts, one row per source, are stored, so that their size is known to the join.
    """
    counts = units.groupBy(F.col("source").alias("__source")).agg(
        F.ceil(F.count("*") / bucket_rows).alias("cuts")
    )
    counts = stored(counts, "cuts")
    placed = (
        units.join(counts, F.col("source").eqNullSafe(F.col("__source")))
        .withColumn("bucket", F.pmod(F.xxhash64("ua", "ub", "un", F.lit(level)), F.col("cuts")))
        .withColumn("last", F.col("cuts") == 1)
        .drop("__source", "cuts")
    )
    return placed, counts.agg(F.max("cuts")).first()[0] or 0


def decided(units: DataFrame, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Units (source, size, ua, ub, un, chance) with ``chance`` moved to 0 or 1.

    The flight runs in hash buckets of each source, so a source with a third of all documents
    is spread over tasks. Each bucket leaves two fractional units at most; they meet in the
    buckets of the next level. A source lands when it is one bucket.
    """
    done, open_, level = [], stored(units, "units"), 0
    while True:
        placed, most = dealt(open_, level, bucket_rows)
        moved = stored(
            placed.groupBy("source", "bucket").applyInPandas(_move(level), UNIT), "flight"
        )
        if most <= 1:
            done.append(moved)
            break
        fractional = (F.col("chance") > EPSILON) & (F.col("chance") < 1 - EPSILON)
        done.append(moved.filter(~fractional))
        open_, level = moved.filter(fractional), level + 1
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def taken_copies(
    keyed: DataFrame, bucket_rows: int = BUCKET_ROWS, carry: tuple[str, ...] = (), **how
) -> DataFrame:
    """One row per class of equal rows: keys, ``__rows``, ``__copies``, its sizes, and ``carry``.

    ``keyed`` comes from :func:`with_row_key`.
    """
    classes = stored(
        keyed.withColumn("__size", word_count())
        .groupBy(*KEYS)
        .agg(
            F.count("*").alias("__rows"),
            F.first("source").alias("source"),
            F.first("__size").alias("size"),
            *[F.first(c).alias(c) for c in carry],
        ),
        "classes",
    )
    sizes = classes.groupBy("source").agg(
        F.sum(F.col("size") * F.col("__rows")).alias("source_size")
    )
    aims = stored(targets(sizes, **how), "targets")
    named = aims.withColumnRenamed("source", "__source")
    aimed = classes.join(named, F.col("source").eqNullSafe(F.col("__source"))).drop("__source")
    expected = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    aimed = aimed.withColumn("__expected", expected).withColumn(
        "__whole", F.floor(F.col("__expected") + EPSILON)
    )
    aimed = stored(aimed, "aimed")
    units = aimed.select(
        "source",
        "size",
        F.col(KEYS[0]).alias("ua"),
        F.col(KEYS[1]).alias("ub"),
        F.explode(F.sequence(F.lit(1).cast("long"), "__rows")).alias("un"),
        F.greatest(F.col("__expected") - F.col("__whole"), F.lit(0.0)).alias("chance"),
    )
    extra = (
        decided(units, bucket_rows)
        .groupBy(F.col("ua").alias(KEYS[0]), F.col("ub").alias(KEYS[1]))
        .agg(F.sum("chance").cast("long").alias("__extra"))
    )
    return stored(
        aimed.join(extra, list(KEYS))
        .withColumn("__copies", F.col("__whole") * F.col("__rows") + F.col("__extra"))
        .select(
            *KEYS,
            *["__rows", "__copies", "__whole", "__extra", "size", "source_size", "target"],
            *carry,
        ),
        "copies",
    )


def mixture(docs: DataFrame) -> DataFrame:
    """The mixed corpus: each document as often as the mix takes it, columns as in ``docs``.

    Every document is expected target / source size times, so 0 to 2 times, and each source's
    documents and words come as near to their expectation as the landing of the last few
    documents allows. A null source is a source of its own. A null text has no words; it follows its
    source's documents, and stays out where the source has no words at all. Equal rows share
    copies. The choice depends on the rows' content only, so reruns agree. Very long texts are
    counted whole. Columns other than text and source may have any names. An empty table gives an
    empty table.
    """
    keyed = with_row_key(docs)
    copies = taken_copies(keyed).select(*KEYS, "__rows", "__copies")
    return multiplied(keyed, copies).select(*[f"`{c}`" for c in docs.columns])


def taken_words(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, size, source_size, target and the words ``taken``.

    Of equal rows the first few take the odd copies; which is arbitrary, as they are equal.
    An empty table gives an empty table.
    """
    keyed = with_row_key(docs)
    row = F.explode(F.sequence(F.lit(1).cast("long"), "__rows"))
    return (
        taken_copies(keyed, carry=("doc_id",))
        .withColumn("__n", row)
        .select(
            "doc_id",
            "size",
            "source_size",
            "target",
            (
                F.col("size")
                * (F.col("__whole") + (F.col("__n") <= F.col("__extra")).cast("long"))
            ).alias("taken"),
        )
    )
