"""Quality rules: counts against a plain version, estimates, and verdicts."""

import random
import re

import llm_cases as cases
import numpy as np
import pytest

from tradewind.llm import outliers, queries


def counts(text):
    text = text or ""
    words = re.findall("[^\x20\x09-\x0d]+", text)
    seen, duplicates = set(), 0
    for line in text.split("\n"):
        if re.search("[^\x20\x09-\x0d]", line):
            duplicates += line in seen
            seen.add(line)
    places = {}
    for i in range(len(words) - 2):
        places.setdefault(tuple(words[i : i + 3]), []).append(i)
    hit = {i + k for found in places.values() if len(found) > 1 for i in found for k in range(3)}
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    failed = len(words) < 50 or 100 * len(hit) > 50 * len(words)
    return len(words), sum(map(len, words)), symbols, duplicates, len(hit), failed


JUNK = [
    " ".join(w.upper() + "!!" for w in cases.prose(5, 200).split()),
    " ".join(w + "###" for w in cases.prose(6, 200).split()),
    " | ".join(cases.prose(8, 200).split()),
    " ".join(f"{i * 7919}" for i in range(150)),
]


def quality_rows():
    rows = cases.rows()
    for source in ("news", "web"):
        rows += [
            (4000 + 1000 * (source == "web") + i, cases.prose(7000 + i, 60 + i), "en", source, 1)
            for i in range(250)
        ]
    rows += [(9000 + i, text, "en", "news", 1) for i, text in enumerate(JUNK)]
    rows += [(9100, "same\nsame\n \n \nsame \nsame\n\n", "en", "news", 1)]
    return rows


NAMES = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def test_counts_equal_plain_version(spark, tmp_path):
    rows = quality_rows()
    folder = cases.stored_documents(cases.table(spark, rows), tmp_path)
    got = queries.op7_robust_outliers(spark, folder)
    want = sorted(((r[0], *counts(r[1])) for r in rows), key=repr)
    assert cases.tuples(got, *NAMES) == want
    kept = {r.doc_id: r.kept for r in got.collect()}
    assert not any(kept[9000 + i] for i in range(len(JUNK)))
    assert all(kept[i] for i in range(4000, 4250)) and all(kept[i] for i in range(5000, 5250))
    assert all(not r.kept for r in got.collect() if r.base_failed)


def test_repeats_equal_plain_version():
    pick = random.Random(1)
    for n in (0, 1, 2, 3, 4, 5, 30, 300):
        for spread in (1, 2, 5, 40):
            ids = np.array([pick.randrange(spread) for _ in range(n)], np.int64)
            text = " ".join(map(str, ids))
            assert outliers.repeat_words(ids) == counts(text)[4]


def plain_mcd(x, floor, starts):
    """Several starts and concentration steps, with an exact sort instead of bins."""

    def step(mean, cov):
        off = x - mean
        far = np.einsum("ij,jk,ik->i", off, np.linalg.inv(cov), off)
        inner = x[np.argsort(far, kind="stable")[: int(np.ceil(outliers.COVERAGE * len(x)))]]
        cov = np.cov(inner.T, bias=True) * outliers.CONSISTENCY
        return inner.mean(axis=0), cov + np.diag(np.maximum(0, floor - np.diag(cov)))

    found = []
    for cov in starts:
        now = (np.zeros(x.shape[1]), cov)
        for _ in range(outliers.START_STEPS):
            now = step(*now)
        found.append(now)
    now = min(found, key=lambda f: np.linalg.slogdet(f[1])[1])
    for _ in range(outliers.STEPS):
        now = step(*now)
    return now


def vectors_of(spark, x, errors):
    rows = [("c", *map(float, row), *map(float, errors)) for row in x]
    names = ", ".join(f"{n} double" for n in (*outliers.NAMES, *outliers.ERRORS))
    return spark.createDataFrame(rows, f"cluster string, {names}").repartition(6)


@pytest.mark.parametrize("far", [0, 200, 450])
def test_estimates_near_plain_version(spark, far):
    """Rows far away, all on one side, move neither; up to nearly a quarter of all."""
    pick = np.random.default_rng(1)
    mixed = np.eye(outliers.D) + 0.4 * pick.normal(0, 1, (outliers.D, outliers.D))
    x = pick.normal(0, 1, (2000, outliers.D)) @ mixed
    x[:far] += 9
    x[:, 3] = 0
    errors = np.full(outliers.D, 0.05)
    found = outliers.estimates(vectors_of(spark, x, errors)).first()
    bent, length = np.tanh(x), np.linalg.norm(x, axis=1, keepdims=True) + 1e-9
    starts = [np.eye(outliers.D)]
    for way in (bent, x / length):
        cov = way.T @ way
        scale = np.sqrt(np.maximum(np.diag(cov), 1e-12))
        starts.append(cov / np.outer(scale, scale) + 0.05 * np.eye(outliers.D))
    mean, cov = plain_mcd(x, errors, starts)
    whiten = np.array(found.whiten).reshape(outliers.D, outliers.D)
    assert np.allclose(found.mean, mean, atol=0.08)
    assert np.allclose(np.linalg.inv(whiten.T @ whiten), cov, rtol=0.1, atol=0.08)
    # The true values, without the far rows.
    assert np.allclose(np.delete(found.mean, 3), 0, atol=0.25)


def test_distances_follow_chi_squared(spark):
    """Of normal rows about the tail's share lies beyond the limit, not far less."""
    x = np.random.default_rng(3).normal(0, 1, (20_000, outliers.D))
    found = outliers.estimates(vectors_of(spark, x, np.full(outliers.D, 0.01))).first()
    whiten = np.array(found.whiten).reshape(outliers.D, outliers.D)
    far = (((x - found.mean) @ whiten.T) ** 2).sum(axis=1)
    assert 4.9 < np.median(far) < 5.8
    assert 0.2 * outliers.TAIL < (far > outliers.LIMIT).mean() < 4 * outliers.TAIL


def altered(text, kind):
    """A clean text made one of the kinds that no person would write."""
    pick, words = random.Random(len(text)), text.split()
    change = {
        "digits": lambda i, w: str(pick.randrange(10**5)) if i % 2 else w,
        "marks": lambda i, w: w + "!",
        "capitals": lambda i, w: w.upper() if i % 2 else w,
        "symbols": lambda i, w: w + "#",
    }[kind]
    return " ".join(change(i, w) for i, w in enumerate(words))


@pytest.mark.parametrize("kind", ["digits", "marks", "capitals", "symbols"])
def test_altered_texts_are_rejected(spark, kind):
    """Texts of every length, a tenth of them altered, the others with a number or a symbol here and there."""
    rows = []
    for i in range(400):
        text = cases.prose(7000 + i, 60 + 3 * i)
        if i % 7 == 0:
            text += " call 555 0199 23 now & again"
        rows.append((i, altered(text, kind) if i % 10 == 5 else text, "en", "news", 1))
    kept = {r.doc_id: r.kept for r in outliers.judged(cases.table(spark, rows)).collect()}
    assert not any(kept[i] for i in kept if i % 10 == 5)
    assert sum(kept[i] for i in kept if i % 10 != 5) >= 0.99 * 360


def test_chi_squared():
    # Known points: 95 % of two degrees, 99 % of six.
    assert abs(outliers.chi2_point(0.05, 2) - 5.9915) < 1e-3
    assert abs(outliers.chi2_point(0.01, 6) - 16.8119) < 1e-3


def test_too_few_documents_are_kept(spark):
    rows = [(i, cases.prose(i, 80), "en", "s", 1) for i in range(20)]
    rows += [(99, JUNK[0], "en", "s", 1)]
    got = outliers.judged(cases.table(spark, rows)).collect()
    assert all(r.kept and r.distance is None for r in got)


def test_small_sources_are_pooled(spark):
    """By language, so junk among many small sources is found."""
    rows = [(i, cases.prose(i, 100), "en", f"s{i}", 1) for i in range(300)]
    rows += [(900 + i, JUNK[i], "en", f"j{i}", 1) for i in range(3)]
    kept = {r.doc_id: r.kept for r in outliers.judged(cases.table(spark, rows)).collect()}
    assert all(kept[i] for i in range(300)) and not any(kept[900 + i] for i in range(3))


def test_good_documents(spark):
    rows = quality_rows()
    docs = cases.table(spark, rows).selectExpr("*", "1 AS cluster", "2 AS n_words", "3 AS kept")
    got = outliers.good_documents(docs)
    assert got.columns == docs.columns
    want = outliers.judged(docs).filter("kept")
    assert cases.tuples(got, "doc_id") == cases.tuples(want, "doc_id")


def test_empty_table(spark):
    assert outliers.judged(cases.empty(spark)).collect() == []
    assert outliers.good_documents(cases.empty(spark)).collect() == []
