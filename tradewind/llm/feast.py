"""Leading eigenpairs of a symmetric matrix by FEAST contour integration."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import SparkSession

# Quadrature nodes on the upper half of a contour, and eigenvalues an interval may hold.
NODES = 8
PER_INTERVAL = 6
ROUNDS = 40
# A pair is found when its residual is below this share of the matrix norm.
RESIDUAL = 2e-14
# Eigenvalues below this share of the largest are rounding, not variance.
RANK = 1e-11


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Diagonal and off-diagonal of a tridiagonal matrix of the same eigenvalues (Householder)."""
    a = matrix.astype(float).copy()
    for k in range(len(a) - 2):
        v = a[k + 1 :, k].copy()
        v[0] += np.copysign(np.linalg.norm(v), v[0])
        norm = np.linalg.norm(v)
        if norm == 0:
            continue
        v /= norm
        rest = a[k + 1 :, k:]
        rest -= 2 * np.outer(v, v @ rest)
        rest = a[k:, k + 1 :]
        rest -= 2 * np.outer(rest @ v, v)
    return np.diag(a).copy(), np.diag(a, -1).copy()


class Inertia:
    """Counts eigenvalues above any value from the signs of an LDL^T factorisation's pivots."""

    def __init__(self, matrix: np.ndarray):
        self.diagonal, self.off = tridiagonal(matrix)
        reach = np.abs(np.r_[self.off, 0]) + np.abs(np.r_[0, self.off])
        self.top = float((self.diagonal + reach).max())
        self.tiny = np.finfo(float).eps ** 2 * max(self.top, np.finfo(float).tiny)

    def above(self, values: np.ndarray | list[float]) -> np.ndarray:
        values = np.asarray(values, float)
        pivot = self.diagonal[0] - values
        count = (pivot > 0).astype(int)
        for diagonal, off in zip(self.diagonal[1:], self.off, strict=True):
            pivot = np.where(np.abs(pivot) < self.tiny, -self.tiny, pivot)
            pivot = diagonal - values - off * off / pivot
            count += pivot > 0
        return count


def intervals(inertia: Inertia, most: int) -> list[tuple[float, float, int]]:
    """Disjoint (low, high, count) that hold the ``most`` largest eigenvalues, the highest first.

    Edges lie in gaps, as their counts a little below and above agree. What no
    edge divides, a cluster, stays one interval.
    """
    high = inertia.top * 1.05
    low, step = 0.0, high
    # The largest eigenvalue, to find what is rounding.
    while step > 1e-3 * (low or high):
        step /= 2
        low = low + step if inertia.above([low + step])[0] else low
    floor = RANK * low
    todo, found = [(floor, high, int(inertia.above([floor])[0]))], []
    while todo and sum(count for *_, count in found) < most:
        low, high, count = todo.pop()
        if count == 0:
            continue
        edge = _edge(inertia, low, high) if count > PER_INTERVAL else None
        if edge is None:
            found.append((low, high, count))
            continue
        upper = int(inertia.above([edge])[0]) - int(inertia.above([high])[0])
        todo += [(low, edge, count - upper), (edge, high, upper)]
    return found


def _edge(inertia: Inertia, low: float, high: float) -> float | None:
    """A value in a gap that divides the eigenvalues between low and high most evenly."""
    below_high, above_low = inertia.above([high, low])
    # Even steps, and steps by ratio towards the lower end, where most eigenvalues may be.
    even = low + (high - low) * np.linspace(0.01, 0.99, 99)
    ratio = high * (max(low, 1e-300) / high) ** np.linspace(0.01, 0.99, 99)
    at = np.unique(np.r_[even, ratio])
    at = at[(at > low) & (at < high)]
    margin = 1e-3 * np.minimum(at - low, high - at)
    counts, less, more = (inertia.above(at + side * margin) for side in (0, -1, 1))
    useful = (less == more) & (counts > below_high) & (counts < above_low)
    if not useful.any():
        return None
    balance = np.abs(2 * counts - below_high - above_low)
    return float(at[useful][np.argmin(balance[useful])])


def _projected(matrix: np.ndarray, low: float, high: float, y: np.ndarray, nodes: int) -> np.ndarray:
    """Quadrature of the resolvent round (low, high): y projected onto the eigenvectors inside."""
    x, weights = np.polynomial.legendre.leggauss(nodes)
    centre, radius = (low + high) / 2, (high - low) / 2
    out = np.zeros_like(y)
    identity = np.eye(len(matrix))
    for angle, weight in zip(np.pi / 2 * (1 - x), weights, strict=True):
        turn = radius * np.exp(1j * angle)
        solved = np.linalg.solve((centre + turn) * identity - matrix, y)
        out += weight / 2 * (turn * solved).real
    return out


def pairs_between(
    matrix: np.ndarray, low: float, high: float, count: int
) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` eigenvalues between low and high, and their unit vectors as columns.

    Ends when Rayleigh-Ritz on the projected space gives as many pairs inside as inertia
    counts, all with small residuals; more columns and nodes are taken until it does.
    """
    size, norm = len(matrix), np.abs(matrix).sum(axis=0).max()
    columns, nodes = min(size, count + count // 2 + 3), NODES
    random = np.random.default_rng(size)
    y = random.standard_normal((size, columns))
    before = np.inf
    for step in range(ROUNDS):
        basis = np.linalg.qr(_projected(matrix, low, high, y, nodes))[0]
        values, small = np.linalg.eigh(basis.T @ matrix @ basis)
        vectors = basis @ small
        inside = (values > low) & (values <= high)
        residual = np.inf
        if inside.sum() == count:
            found = vectors[:, inside]
            residual = np.linalg.norm(matrix @ found - found * values[inside], axis=0).max() / norm
            # Below the bound, go on while it still falls.
            if residual <= RESIDUAL and residual >= before / 2:
                return values[inside], found / np.linalg.norm(found, axis=0)
        before = residual
        if step % 8 == 7:
            columns, nodes = min(size, 2 * columns), 2 * nodes
            vectors = np.c_[vectors, random.standard_normal((size, columns - vectors.shape[1]))]
        y = vectors
    raise RuntimeError(f"{count} eigenvalues between {low} and {high} are not all found")


def leading_pairs(
    spark: SparkSession, matrix: np.ndarray, most: int
) -> tuple[np.ndarray, np.ndarray]:
    """The ``most`` largest eigenvalues that are more than rounding, falling, and their vectors.

    Each interval is one Spark task. In a vector the entry of largest size is positive.
    """
    size = len(matrix)
    cuts = intervals(Inertia(matrix), min(most, size)) if matrix.any() else []
    if not cuts:
        return np.empty(0), np.empty((size, 0))
    shared = spark.sparkContext.broadcast(matrix)

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for low, high, count in batch.itertuples(index=False):
                values, vectors = pairs_between(shared.value, low, high, int(count))
                yield pd.DataFrame({"value": values, "vector": list(vectors.T)})

    rows = (
        spark.createDataFrame(cuts, "low double, high double, count int")
        .repartition(len(cuts))
        .mapInPandas(solve, "value double, vector array<double>")
        .collect()
    )
    shared.unpersist()
    rows = sorted(rows, key=lambda row: -row["value"])[:most]
    vectors = np.array([row["vector"] for row in rows]).T
    signs = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(len(rows))])
    return np.array([row["value"] for row in rows]), vectors * signs
