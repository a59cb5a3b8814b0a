"""Whitening and FEAST against numpy's eigenvectors."""

import math
import random
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from tradewind.llm import feast, queries, whitening

SCHEMA = "vec_id long, embedding array<float>, label int"


def whole(vector):
    return [math.floor(64 * float(np.float32(c))) + 1_000_000 for c in vector]


def rows(n=400, d=20):
    pick = random.Random(4)
    out = [(i, [pick.gauss(0, 1 + j % 7 / 3) for j in range(d)], i % 3) for i in range(n)]
    # A third of all rows are one vector, others repeat with their id or without one.
    out += [(1000 + i, out[5][1], None) for i in range(n // 2)] + [out[7], out[7], (None, out[9][1], 1)]
    broken = list(out[0][1])
    out += [(2000, None, 1), (2001, [], 1), (2002, broken[:-1], 1), (2003, broken[:-1] + [None], 1)]
    out += [(2004 + i, broken[:-1] + [v], 1) for i, v in enumerate((math.nan, math.inf, -math.inf))]
    return out


def table(spark, data):
    return spark.createDataFrame(data, SCHEMA).repartition(7)


def expected(data, d):
    """Everything from exact sums and numpy's own eigenvectors."""
    good = [(i, whole(v)) for i, v, _ in data if v and len(v) == d
            and all(c is not None and math.isfinite(c) for c in v)]
    fit = [list(x) for x in {tuple(x) for _, x in good}]
    n, sums = len(fit), [sum(column) for column in zip(*fit, strict=True)]
    centred = lambda x: [float(Fraction(n * a - s, n)) for a, s in zip(x, sums, strict=True)]
    c = np.array([centred(x) for x in fit])
    values, vectors = np.linalg.eigh(c.T @ c / n)
    order = np.argsort(values)[::-1][: whitening.COMPONENTS]
    values, vectors, trace = values[order], vectors[:, order], values.sum()
    keep = values > 1e-11 * values.max()
    values, vectors = values[keep], vectors[:, keep]
    vectors = vectors * np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(len(values))])
    out = []
    for i, x in good:
        deviation = sum((n * a - s) ** 2 for a, s in zip(x, sums, strict=True))
        on = np.array(centred(x)) @ vectors / np.sqrt(values)
        out += [(i, k + 1, n, deviation, w, values[k] / trace) for k, w in enumerate(on)]
    return out


def compared(found, want):
    key = lambda r: (repr(r[0]), r[1], round(r[4], 6))
    found, want = sorted(found, key=key), sorted(want, key=key)
    assert [r[:4] for r in found] == [r[:4] for r in want]
    for a, b in zip(found, want, strict=True):
        assert abs(a[4] - b[4]) < 1e-8 and abs(a[5] - b[5]) < 1e-10


NAMES = ("vec_id", "component", "n", "deviation", "whitened", "explained")


@pytest.mark.parametrize("n, d", [(400, 20), (12, 30), (300, 5)])
def test_query_equals_plain_version(spark, tmp_path, n, d):
    data = rows(n, d)
    table(spark, data).write.parquet(f"{tmp_path}/embeddings.parquet")
    got = queries.op13_feast_whitening(spark, str(tmp_path)).collect()
    compared([tuple(r[c] for c in NAMES) for r in got], expected(data, d))
    assert {r["identity_error"] for r in got}.pop() < 1e-9 and len({r["identity_error"] for r in got}) == 1


def test_far_entries_stay_exact(spark):
    data = [(i, [float(3 * i % 11), 2.0**20 * (i % 5), 1e30 if i == 3 else float(i)], 0) for i in range(40)]
    got = whitening.whitened(table(spark, data)).collect()
    x = [[a, b, min(c, 10**15 + 1_000_000)] for a, b, c in (whole(v) for _, v, _ in data)]
    sums = [sum(c) for c in zip(*x, strict=True)]
    want = {i: sum((40 * a - s) ** 2 for a, s in zip(v, sums, strict=True)) for i, v in enumerate(x)}
    assert {(r["vec_id"], int(r["deviation"])) for r in got} == set(want.items())


@pytest.mark.parametrize(
    "data",
    [[], [(1, None, 1)], [(1, [], 1)], [(1, [1.0, 2.0], 1)], [(i, [1.0, 2.0], 1) for i in range(9)]],
)
def test_without_variance_no_rows(spark, data):
    found = whitening.whitened(table(spark, data))
    assert found.collect() == [] and found.columns[:2] == ["vec_id", "component"]


def test_clashing_columns_and_other_types(spark):
    data = [r for r in rows(60, 4) if r[1] and None not in r[1]]
    plain = table(spark, data)
    wide = plain.withColumn("embedding", F.col("embedding").cast("array<double>")).select(
        "*", *[F.lit(1).alias(c) for c in ("x", "n", "component", "whitened", "__at")]
    )
    names = ("vec_id", "component", "deviation")
    pairs = [sorted(map(repr, df.select(*names).collect())) for df in
             (whitening.whitened(plain), whitening.whitened(wide))]
    assert pairs[0] == pairs[1] and len(pairs[0]) > 100


def spectra():
    random_ = np.random.default_rng(1)
    base = np.linalg.qr(random_.standard_normal((40, 40)))[0]
    yield "spread", base * np.linspace(1, 40, 40) @ base.T
    yield "steep", base * np.exp(-np.arange(40.0) / 2) @ base.T
    yield "close", base * (1 + 1e-7 * np.arange(40)) @ base.T
    yield "clusters", base * np.repeat([1.0, 5, 5.5, 9], 10) @ base.T
    yield "equal", 3 * np.eye(40)
    yield "one", np.outer(base[0], base[0])
    yield "diagonal", np.diag(np.arange(40.0))


@pytest.mark.parametrize("name, matrix", list(spectra()), ids=lambda v: v if isinstance(v, str) else "")
def test_feast_finds_all(spark, name, matrix):
    want = np.linalg.eigvalsh(matrix)[::-1][:16]
    want = want[want > 1e-11 * want[0]]
    values, vectors = feast.leading_pairs(spark, matrix, 16)
    assert np.allclose(values, want, rtol=1e-7, atol=1e-12 * want[0])
    # Residuals hold for every vector, equal eigenvalues included.
    assert np.abs(matrix @ vectors - vectors * values).max() < 1e-12 * want[0]
    assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() < 1e-6


def test_inertia_counts():
    random_ = np.random.default_rng(2)
    matrix = random_.standard_normal((25, 25))
    matrix = matrix @ matrix.T
    values = np.linalg.eigvalsh(matrix)
    at = np.r_[values - 1e-9, values + 1e-9, 0.0, 1e6]
    assert feast.Inertia(matrix).above(at).tolist() == [(values > a).sum() for a in at]
