"""Mixing: targets against a plain version, and the balance that the cube method keeps."""

import re
from collections import Counter, defaultdict

import llm_cases as cases
import numpy as np
import pytest
from pyspark.sql import functions as F

from tradewind.llm import mixing, queries


def size_of(text):
    return len(re.findall("[^\x20\x09-\x0d]+", text or ""))


def plain_targets(rows):
    sizes = defaultdict(int)
    for _, text, _, source, _ in rows:
        sizes[source] += size_of(text)
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    total, capped = 1.5 * sum(sizes.values()), set()
    while True:
        left = total - sum(2 * sizes[s] for s in capped)
        free = [s for s in names if s not in capped]
        target = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        above = {s for s in free if target[s] > 2 * sizes[s]}
        if not above:
            return sizes, target | {s: 2.0 * sizes[s] for s in capped}
        capped |= above


def mixed_rows():
    rows = cases.rows()
    rows += [(1000 + i, cases.prose(i, 5 + i % 70), "en", "big", 1) for i in range(900)]
    rows += [(3000 + i, None, "en", "wordless", 1) for i in range(3)]
    return rows


def test_query(spark, tmp_path):
    rows = mixed_rows()
    folder = cases.stored_documents(cases.table(spark, rows), tmp_path)
    got = queries.op4_cube_mixture(spark, folder).collect()
    sizes, target = plain_targets(rows)
    source = {(r[0], size_of(r[1])): r[3] for r in rows}
    assert sorted(((r.doc_id, r["size"]) for r in got), key=repr) == sorted(
        ((r[0], size_of(r[1])) for r in rows), key=repr
    )
    taken = Counter()
    for r in got:
        s = source[r.doc_id, r["size"]]
        assert r.source_size == sizes[s]
        assert r.target == pytest.approx(target[s], rel=1e-9)
        assert 0 <= r.taken <= 2 * r["size"] and r.taken % max(1, r["size"]) == 0
        taken[s] += r.taken
    for s, want in target.items():
        largest = max(size_of(r[1]) for r in rows if r[3] == s)
        assert abs(taken[s] - want) <= 2 * largest
    assert abs(taken["big"] - target["big"]) <= 2


def test_reruns_and_partitions_agree(spark):
    names = ("doc_id", "size", "taken")
    a = cases.tuples(mixing.taken_words(cases.table(spark, mixed_rows(), 3)), *names)
    b = cases.tuples(mixing.taken_words(cases.table(spark, mixed_rows(), 11)), *names)
    assert a == b


def test_small_buckets_keep_the_balance(spark):
    """Several levels of flight: words and documents of the source still come out."""
    from pyspark.sql import functions as F

    from tradewind.llm.rows import KEYS, with_row_key

    rows = mixed_rows()
    copies = mixing.taken_copies(with_row_key(cases.table(spark, rows)), bucket_rows=20)
    sizes, target = plain_targets(rows)
    big = copies.filter(F.col("source_size") == sizes["big"])
    words, docs, n = big.agg(
        F.sum(F.col("size") * F.col("__copies")), F.sum("__copies"), F.sum("__rows")
    ).first()
    assert abs(words - target["big"]) <= 2
    assert abs(docs - n * target["big"] / sizes["big"]) <= 7
    assert set(KEYS) <= set(copies.columns)


def test_flight_keeps_both_sums():
    pick = np.random.default_rng(1)
    size = pick.integers(1, 500, 400)
    chance = np.full(400, 0.37)
    moved = mixing.flight(chance, size, (1,))
    open_ = (moved > 1e-9) & (moved < 1 - 1e-9)
    assert open_.sum() <= 2
    assert moved.sum() == pytest.approx(chance.sum(), abs=1e-6)
    assert (moved * size).sum() == pytest.approx((chance * size).sum(), rel=1e-9)
    landed = mixing.landing(moved, size)
    assert set(landed) <= {0.0, 1.0}
    spared = mixing.flight(chance, size, (1,), 14)
    assert 2 < ((spared > 1e-9) & (spared < 1 - 1e-9)).sum() <= 14
    # Over all ways of rounding fourteen documents, hardly a word is missed.
    assert abs((mixing.landing(spared, size) * size).sum() - (chance * size).sum()) <= 2


def test_flight_keeps_expectations():
    """Over many keys the chances stay what they were on average."""
    size = np.array([5, 40, 7, 300, 12, 90, 3, 8])
    drawn = [mixing.flight(np.full(8, 0.3), size, (k,)) for k in range(4000)]
    assert np.all(np.abs(np.mean(drawn, axis=0) - 0.3) < 0.03)


def test_equal_sizes_and_tiny_groups():
    assert mixing.flight(np.array([0.5]), np.array([3]), (0,)).tolist() == [0.5]
    moved = mixing.flight(np.full(50, 0.5), np.full(50, 9), (0,))
    assert ((moved > 1e-9) & (moved < 1 - 1e-9)).sum() <= 2
    assert mixing.landing(np.array([]), np.array([])).tolist() == []


def test_mixture_takes_effect(spark):
    rows = mixed_rows()
    docs = cases.table(spark, rows).selectExpr("*", "1 AS size", "2 AS target", "3 AS ua")
    out = mixing.mixture(docs)
    assert out.columns == docs.columns
    taken = Counter()
    for r in mixing.taken_words(docs).collect():
        taken[r.doc_id] += r.taken
    got = Counter()
    for r in out.collect():
        got[r.doc_id] += size_of(r.text)
    assert +got == +taken


def test_empty_table(spark):
    assert mixing.taken_words(cases.empty(spark)).collect() == []
    assert mixing.mixture(cases.empty(spark)).collect() == []
    wordless = cases.table(spark, [(1, None, "", "a", 1), (2, "", "", None, 1)])
    assert [r.taken for r in mixing.taken_words(wordless).collect()] == [0, 0]


def test_small_sources_beside_a_large_one_stay_one_bucket(spark):
    units = spark.range(30_000).selectExpr(
        "CASE WHEN id % 3 > 0 THEN 'hot' WHEN id % 2 = 0 THEN NULL ELSE concat('s', id % 2000) END AS source",
        "id % 50 AS size", "id AS ua", "id * 7 AS ub", "1L AS un", "0.3D AS chance",
    )
    placed, most = mixing.dealt(units, 0, 500)
    groups = {(r.source, r.bucket): (r.n, r.last) for r in placed.groupBy("source", "bucket").agg(
        F.count("*").alias("n"), F.first("last").alias("last")).collect()}
    assert sum(n for n, _ in groups.values()) == 30_000 and most == 40
    assert max(n for n, _ in groups.values()) < 1000
    sources = {s for s, _ in groups}
    assert len(groups) <= len(sources) + 40 + 10
    assert all(last for (s, _), (_, last) in groups.items() if s and s != "hot")
    moved = mixing.decided(units, 500)
    assert {r.chance for r in moved.select(F.round("chance", 6).alias("chance")).distinct().collect()} <= {0.0, 1.0}
    sums = {r.source: (r.n, r.taken) for r in moved.groupBy("source").agg(
        F.count("*").alias("n"), F.sum("chance").alias("taken")).collect()}
    assert all(abs(taken - 0.3 * n) <= 8 for n, taken in sums.values())


def best_rounding(size, chance):
    """The least miss in words over all roundings that keep the number of documents to one."""
    from itertools import product

    aim, count = (chance * size).sum(), chance.sum()
    return min(
        abs(np.dot(pick, size) - aim)
        for pick in product((0, 1), repeat=len(size))
        if abs(sum(pick) - count) <= 7
    )


def test_landing_equals_all_roundings():
    pick = np.random.default_rng(5)
    for _ in range(40):
        n = int(pick.integers(1, 11))
        size, chance = pick.integers(0, 60, n), pick.random(n)
        landed = mixing.landing(chance, size)
        missed = abs((landed * size).sum() - (chance * size).sum())
        assert missed <= best_rounding(size, chance) + max(1.0, 0.02 * size.sum())
