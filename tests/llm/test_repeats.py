"""Periodic runs against a plain search of every diagonal."""

import hashlib
import random
import zlib

import llm_cases as cases
import numpy as np
import pytest

from tradewind.llm import queries, repeats

COLUMNS = (
    "doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256",
    "collapsed_sha256",
)


def plain_runs(words):
    """Every stretch of every diagonal; smallest periods by trying all shorter ones."""
    n, out = len(words), []
    for q in range(1, n // 2 + 1):
        i = 0
        while i < n - q:
            s = i
            while i < n - q and words[i] == words[i + q]:
                i += 1
            length = i - s + q
            if length >= max(12, 2 * q):
                part = words[s : s + length]
                if not any(part[p:] == part[:-p] for p in range(1, q)):
                    out.append((s, length, q))
            i += 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def expected(rows):
    out = []
    for doc_id, text, *_ in rows:
        words = [w for w in repeats.WORD.findall(text or "") if w]
        n = len(words)
        h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
        if h % 10 == 0 and n:
            a = h // 10 % n
            p = 1 + (n - a) // (3 + h // 10 % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        found = plain_runs(words)
        dropped = {i for s, length, q in found for i in range(s + q, s + length)}
        best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=None)
        numbers = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
        listed = "".join(f"{s},{length},{q}\n" for s, length, q in found)
        left = " ".join(w for i, w in enumerate(words) if i not in dropped)
        out.append((doc_id, len(found), *numbers, digest(listed), digest(left)))
    return sorted(out, key=repr)


def awkward_rows():
    rows = [r for r in cases.rows() if len((r[1] or "").split()) < 2500]
    pick = random.Random(5)
    word = lambda n: "w" + str(pick.randrange(n))
    for i in range(150):
        words = [word(4) for _ in range(pick.randrange(60))]
        unit = [word(9) for _ in range(1 + pick.randrange(40))]
        # An odd part of a period at the end, and separators of every kind.
        words += unit * (1 + i % 5) + unit[: i % 7]
        rows.append((1000 + i, pick.choice([" ", "\n", " \t", "\x0b\x0c\r"]).join(words), "en", "s", 1))
    rows += [(2000, "one " * 700, "en", "s", 1), (2001, "a b " * 6, "en", "s", 1)]
    rows += [(2002, "a b " * 5 + "a", "en", "s", 1), (2003, "x " * 11, "en", "s", 1)]
    # Unbreakable space is part of a word.
    rows += [(2004, "a b " * 12, "en", "s", 1), (2005, " ".join("ab" * 9), "en", "s", 1)]
    rows += [(2006 + i, "p q r s t u v " * 3 + "end", "en", "s", 1) for i in range(30)]
    return rows


def test_query_equals_plain_version(spark, tmp_path):
    rows = awkward_rows()
    folder = cases.stored_documents(cases.table(spark, rows), tmp_path)
    got = cases.tuples(queries.op11_periodic_runs(spark, folder), *COLUMNS)
    want = expected(rows)
    assert got == want and sum(r[1] > 0 for r in got) > 100


def fibonacci(n):
    a, b = [0], [0, 1]
    while len(b) < n:
        a, b = b, b + a
    return b[:n]


# Words whose k-grams repeat most: one word, powers, blocks, Fibonacci and Thue-Morse.
HARD = {
    "one word": [0] * 150,
    "squares of squares": ([0, 0, 1, 0, 0, 1, 2] * 3 + [3]) * 5,
    "blocks": ([0] * 30 + [1]) * 5,
    "uneven blocks": [0] * 31 + [1] + [0] * 28 + [1] + [0] * 31 + [1] + [0] * 28,
    "fibonacci": fibonacci(180),
    "thue-morse": [bin(i).count("1") % 2 for i in range(180)],
}


@pytest.mark.parametrize("name", HARD)
def test_hard_words(name):
    words = HARD[name]
    assert [tuple(r) for r in repeats.runs(np.array(words)).tolist()] == plain_runs(words)


def test_random_words():
    pick = random.Random(2)
    for _ in range(600):
        letters = pick.choice([1, 2, 2, 3, 5, 30])
        words = [pick.randrange(letters) for _ in range(pick.randrange(110))]
        assert [tuple(r) for r in repeats.runs(np.array(words, int)).tolist()] == plain_runs(words)


@pytest.mark.parametrize("unit", [1, 7, 1001])
def test_pairs_stay_in_proportion(unit):
    """A text of one period has as many seeds as words, not as many as pairs of words."""
    words = np.arange(60_000) % unit
    grams = repeats.Grams(words)
    pairs = sum(
        len(repeats.seeds(names, k, 1 if k == 6 else k, min(2 * k, 30_001)))
        for names, k in zip(grams.names, grams.lengths, strict=True)
    )
    assert pairs <= 20 * len(words)
    assert repeats.runs(words).tolist() == [[0, 60_000, unit]]


def test_empty_table_and_clashing_columns(spark):
    assert repeats.periodic_runs(cases.empty(spark)).collect() == []
    docs = cases.table(spark)
    plain = repeats.periodic_runs(docs)
    clashing = docs.selectExpr("*", "1 AS runs", "2 AS n_words", "'x' AS collapsed", "3 AS __found")
    names = ("doc_id", "n_words", "collapsed")
    assert cases.tuples(repeats.periodic_runs(clashing), *names) == cases.tuples(plain, *names)
    rows = {r["doc_id"]: r for r in plain.collect()}
    assert rows[300]["n_words"] == 0 and rows[300]["runs"] == [] and rows[300]["collapsed"] == ""
    assert [tuple(r) for r in rows[309]["runs"]] == [(0, 3000, 1)] and rows[309]["collapsed"] == "word"
