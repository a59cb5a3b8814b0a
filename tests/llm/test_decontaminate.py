"""Benchmark decontamination against a plain search."""

import hashlib
import re

import llm_cases as cases
import pytest

from tradewind.llm import decontaminate, queries

ITEMS = [
    (1, cases.prose(900, 40)),
    (2, cases.prose(901, 12)),
    (3, "Only Four, words!"),
    (4, None),
    (5, ""),
    (6, cases.prose(900, 40)),
    (7, "Größe ÉTÉ 日本語"),
    (10, "the the the the the the the the the the the the"),
    (None, cases.prose(902, 15)),
    (11, "..."),
]
ITEM_SCHEMA = "item_id long, text string"


def words(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lowered)


def expected(rows, items):
    windows = []
    for item, text in items:
        found = words(text)
        if found:
            n = min(10, len(found))
            name = "" if item is None else str(item)
            windows += [(name, found[i : i + n]) for i in range(len(found) - n + 1)]
    out = []
    for doc_id, text, *_ in rows:
        own = words(text)
        hit, names = set(), set()
        for name, window in windows:
            n = len(window)
            for i in range(len(own) - n + 1):
                if own[i] == window[0] and own[i : i + n] == window:
                    hit.update(range(i, i + n))
                    names.add(name)
        digest = hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
        out.append((doc_id, len(own), len(hit), len(names), digest, bool(hit)))
    return sorted(out, key=repr)


def leaking_rows():
    rows = [r for r in cases.rows() if r[1] is None or len(r[1]) < 20_000]
    rows += [
        (800, "Before. " + cases.prose(900, 40).upper() + " After.", "en", "s", 1),
        (801, " ".join(cases.prose(900, 40).split()[5:15]), "en", "s", 1),
        (802, " ".join(cases.prose(900, 40).split()[5:14]), "en", "s", 1),
        (803, "we have only,four--WORDS here", "en", "s", 1),
        (804, "größe été 日本語 and Größe\x7fÉTÉ 日本語", "de", "s", 1),
        (805, "the " * 500, "en", "s", 1),
        (806, cases.prose(902, 15) + " " + cases.prose(901, 12), "en", "s", 1),
    ]
    return rows


@pytest.mark.parametrize("block_words", [100_000, 60])
def test_query_equals_plain_search(spark, tmp_path, monkeypatch, block_words):
    """In one pass, and in several."""
    scanned = decontaminate.scanned
    monkeypatch.setattr(
        decontaminate, "scanned", lambda d, b: scanned(d, b, block_words=block_words)
    )
    rows = leaking_rows()
    folder = cases.stored_documents(cases.table(spark, rows), tmp_path)
    spark.createDataFrame(ITEMS, ITEM_SCHEMA).write.parquet(f"{folder}/benchmark.parquet")
    got = queries.op5_aho_corasick(spark, folder)
    names = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    assert cases.tuples(got, *names) == expected(rows, ITEMS)


def test_spans_point_into_the_original(spark):
    text = "X, " + " ; ".join(cases.prose(900, 40).upper().split()[:10]) + " zzz"
    docs = cases.table(spark, [(1, text, "", "", 1)])
    bench = spark.createDataFrame(ITEMS[:1], ITEM_SCHEMA)
    (span,) = decontaminate.scanned(docs, bench).first()["__spans"]
    assert words(text[span.start : span.end]) == words(cases.prose(900, 40))[:10]


def test_empty_tables(spark):
    none = spark.createDataFrame([], ITEM_SCHEMA)
    assert decontaminate.scanned(cases.empty(spark), none).collect() == []
    got = decontaminate.clean_documents(cases.table(spark), none)
    assert got.count() == len(cases.rows())
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars"]


def test_blocks_are_bounded_and_whole(spark):
    """Repeats of one item, a third of the rows, and items longer than a block."""
    items = [(i, cases.prose(3000 + i, 5 + i % 40)) for i in range(200)]
    items += [(900, cases.prose(1, 400))]
    rows = items + [items[3]] * 100
    table = spark.createDataFrame(rows, ITEM_SCHEMA).repartition(7)
    blocks = list(decontaminate._blocks(table, 150))
    found = [pair for block in blocks for pair in block]
    assert sorted(found) == sorted((str(i), t) for i, t in items)
    for block in blocks:
        assert len(block) == 1 or sum(len(words(t)) for _, t in block) <= 150
    assert len(blocks) > 10 and list(decontaminate._blocks(table, 10**6))[1:] == []


def test_clashing_columns(spark):
    bench = spark.createDataFrame(ITEMS, ITEM_SCHEMA)
    docs = cases.table(spark, leaking_rows())
    clashing = docs.selectExpr("*", "1 AS items", "2 AS spans", "'x' AS item", "3 AS chars")
    got = decontaminate.clean_documents(clashing, bench)
    assert got.columns == clashing.columns
    assert cases.tuples(got, "doc_id", "text") == cases.tuples(
        decontaminate.clean_documents(docs, bench), "doc_id", "text"
    )
