"""Embeddings on their leading principal components, at unit variance."""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.llm.feast import leading_pairs
from tradewind.llm.rows import stored

COMPONENTS = 16
# Entries become whole numbers: so many steps to one, counted from the offset.
STEPS, OFFSET = 64, 1_000_000
# Entries further out count as this one, so that sums over any table stay exact.
FURTHEST = 10**15
# The covariance, which the driver and each task hold, takes eight bytes for the square of it.
MOST_DIMENSIONS = 4096

RESULT = "deviation decimal(38,0), whitened array<double>"


def whole_entries(vector: Column) -> Column:
    """A vector's entries as long; null if it is null or an entry is null, NaN or infinite."""

    def good(c: Column) -> Column:
        return c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))

    def whole(c: Column) -> Column:
        steps = F.greatest(F.least(c * STEPS, F.lit(float(FURTHEST))), F.lit(-float(FURTHEST)))
        return F.floor(steps) + OFFSET

    doubles = vector.cast("array<double>")
    return F.when(F.forall(doubles, good), F.transform(doubles, whole).cast("array<long>"))


def _batches(parts: Iterator[pd.DataFrame]) -> Iterator[np.ndarray]:
    for part in parts:
        if len(part):
            yield np.stack(part["x"].to_numpy())


def _summed(fit: DataFrame, dimensions: int) -> tuple[int, list[int]]:
    """Number of vectors and exact sums by dimension."""

    def add(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows, totals = 0, np.zeros(dimensions, object)
        for x in _batches(parts):
            rows += len(x)
            # Two halves, neither of which can overflow in a batch.
            totals += (x >> 20).sum(axis=0).astype(object) * 2**20 + (x & (2**20 - 1)).sum(axis=0)
        if rows:
            yield pd.DataFrame(
                {"i": range(dimensions), "rows": rows, "s": [Decimal(int(t)) for t in totals]}
            )

    sums = (
        fit.mapInPandas(add, "i int, rows long, s decimal(38,0)")
        .groupBy("i")
        .agg(F.sum("rows").alias("rows"), F.sum("s").alias("s"))
        .collect()
    )
    sums.sort(key=lambda row: row["i"])
    return (sums[0]["rows"] if sums else 0), [int(row["s"]) for row in sums]


def _centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """x minus the mean: whole parts exactly, then the fraction."""
    whole = np.array([s // n for s in sums], np.int64)
    rest = np.array([s % n / n for s in sums])
    return (x - whole) - rest


def _products(fit: DataFrame, n: int, sums: list[int], projection: np.ndarray) -> np.ndarray:
    """Covariance of the centred vectors times the projection.

    Every task adds its own products; what reaches the driver is one number per pair.
    """
    size = projection.shape[1]
    at = np.tril_indices(size)

    def add(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((size, size))
        for x in _batches(parts):
            c = _centred(x, n, sums) @ projection
            total += c.T @ c
        if total.any():
            yield pd.DataFrame({"i": at[0], "j": at[1], "v": total[at]})

    added = (
        fit.mapInPandas(add, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v"))
    )
    out = np.zeros((size, size))
    for row in added.collect():
        out[row["i"], row["j"]] = out[row["j"], row["i"]] = row["v"] / n
    return out


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> list[Decimal]:
    """Sum over dimensions of (n*x - S)^2, exactly."""
    furthest = int(np.abs(x).max())
    of_mean = max(abs(s) // n for s in sums) + 1
    if 2 * n * (furthest + of_mean) < 2**62:
        off = n * x - np.array(sums, np.int64)
        if len(sums) * int(np.abs(off).max()) ** 2 < 2**62:
            return [Decimal(int(d)) for d in (off * off).sum(axis=1)]
    off = n * x.astype(object) - np.array(sums, object)
    return [Decimal(int(d)) for d in (off * off).sum(axis=1)]


def whitened(
    vectors: DataFrame,
    keep: tuple[str, ...] = ("vec_id",),
    column: str = "embedding",
    components: int = COMPONENTS,
) -> DataFrame:
    """One row per vector and component: ``keep`` columns, ``component`` from 1, ``n``,
    ``deviation``, ``whitened``, ``explained`` and ``identity_error``.

    A vector that is null or holds a null, NaN or infinite entry gives no rows. Entries become
    whole numbers of 1/64; those beyond 10^15 count as that. Vectors must share a length: the one that most
    have, of equals the longer; others give no rows. All distinct vectors, once each,
    are the fit list of ``n``; the components are the leading eigenvectors of its covariance.
    Where fewer than ``components`` have a variance above rounding (``feast.RANK``), as with few
    vectors, only those are given; a single distinct vector gives no rows, neither do an
    empty table or vectors without entries. ``deviation`` is decimal, null beyond 38 digits.
    ``identity_error`` is measured over the fit list. Null and repeated ids stay; columns that
    are not kept do not matter, so none clashes.

    Equal vectors are merged before the shuffle, so copies make no hot key. The covariance,
    bounded by ``MOST_DIMENSIONS``, is all that passes through the driver.
    """
    kept = [F.col(c).alias(f"__keep_{i}") for i, c in enumerate(keep)]
    coded = vectors.select(*kept, whole_entries(F.col(column)).alias("x")).filter("x IS NOT NULL")
    lengths = coded.groupBy(F.size("x").alias("d")).agg(F.count("*").alias("n"))
    common = lengths.orderBy(F.desc("n"), F.desc("d")).first()
    dimensions = common["d"] if common else 0
    if dimensions > MOST_DIMENSIONS:
        raise ValueError(f"{dimensions} dimensions, more than {MOST_DIMENSIONS}")
    coded = coded.filter(F.size("x") == dimensions)

    n, sums = 0, []
    values, axes, error = np.empty(0), np.empty((dimensions, 0)), 0.0
    explained: list[float] = []
    if dimensions:
        fit = stored(coded.select("x").distinct(), "fit-vectors")
        n, sums = _summed(fit, dimensions)
        covariance = _products(fit, n, sums, np.eye(dimensions))
        values, axes = leading_pairs(vectors.sparkSession, covariance, components)
        axes = axes / np.sqrt(values)
        explained = (values / np.trace(covariance)).tolist()
        if len(values):
            error = float(np.abs(_products(fit, n, sums, axes) - np.eye(len(values))).max())

    def project(column: pd.Series) -> pd.DataFrame:
        if not len(column):
            return pd.DataFrame({"deviation": [], "whitened": []})
        x = np.stack(column.to_numpy())
        on_axes = _centred(x, n, sums) @ axes
        exact = [d if abs(d) < 10**38 else None for d in _deviations(x, n, sums)]
        return pd.DataFrame({"deviation": exact, "whitened": list(on_axes)})

    placed = coded if len(values) else coded.limit(0)
    return (
        placed.withColumn("__found", F.pandas_udf(project, RESULT)("x"))
        .select(
            *[f"__keep_{i}" for i in range(len(keep))],
            "__found.deviation",
            F.posexplode("__found.whitened").alias("__at", "whitened"),
        )
        .select(
            *[F.col(f"__keep_{i}").alias(c) for i, c in enumerate(keep)],
            (F.col("__at") + 1).alias("component"),
            F.lit(n).cast("long").alias("n"),
            "deviation",
            "whitened",
            F.get(F.array(*map(F.lit, explained)).cast("array<double>"), F.col("__at")).alias(
                "explained"
            ),
            F.lit(error).alias("identity_error"),
        )
    )
