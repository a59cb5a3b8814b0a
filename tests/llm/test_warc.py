"""WARC round trips, and ownership of records by byte ranges."""

import gzip
import hashlib
import random

import llm_cases as cases
import pytest

from tradewind.llm import queries, warc

PAGE_SCHEMA = "page_id long, url string, html string"


def page_rows():
    pick = random.Random(2)
    text = lambda n: "".join(pick.choice("abc <>é\n\r\x00日") for _ in range(n))
    shared, small = text(1500), text(300)
    rows = [(i, f"http://h{i % 3}/p{i}", text(200 + 57 * i)) for i in range(60)]
    rows += [(100 + i, f"http://c/{i}", shared) for i in range(9)]
    rows += [(120 + i, None, small) for i in range(5)]
    rows += [
        (130, "http://x/null", None),
        (131, "http://x/empty", ""),
        (132, "http://x/\r\nWARC-Type: fake", "WARC/1.1\r\nWARC-Type: response\r\n\r\n"),
        (133, "http://x/long", text(400_000)),
        (None, "http://x/none", text(2000)),
        (None, "http://c/none", shared),
        (134, "http://x/repeated", shared[::-1]),
        (134, "http://x/repeated", shared[::-1]),
        (135, "http://x/edge", "y" * 1000),
        (136, "http://x/edge", "y" * 1000),
        (137, "http://x/edge", "z" * 999),
        (138, "http://x/edge", "z" * 999),
        (-5, "http://x/minus", "m" * 1200),
    ]
    return rows


def expected(rows):
    first = {}
    for page_id, _, text in rows:
        if len((text or "").encode()) >= 1000 and page_id is not None:
            first[text] = max(first.get(text, page_id), page_id)
    out = []
    for page_id, _, text in rows:
        raw = (text or "").encode()
        to = first.get(text)
        revisit = to is not None and to != page_id
        kind = "revisit" if revisit else "response"
        out.append((page_id, len(raw), hashlib.sha1(raw).hexdigest(), kind, to if revisit else None))
    return sorted(out, key=repr)


NAMES = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def test_query_equals_plain_version(spark, tmp_path):
    spark.createDataFrame(page_rows(), PAGE_SCHEMA).repartition(4).write.parquet(
        f"{tmp_path}/pages.parquet"
    )
    got = queries.op10_warc_round_trip(spark, str(tmp_path))
    assert cases.tuples(got, *NAMES) == expected(page_rows())


@pytest.mark.parametrize("size", [37, 1000, 65_536, 1 << 24])
def test_every_range_size_finds_each_record_once(spark, tmp_path, monkeypatch, size):
    rows = page_rows()[:25] if size == 37 else page_rows()
    folder = f"{tmp_path}/archive"
    pages = spark.createDataFrame(rows, PAGE_SCHEMA).coalesce(2)
    warc.write_archives(pages, folder)
    got = warc.read_archives(spark, folder, range_bytes=size).collect()
    want = {(i, u, (t or "").encode()) for i, u, t in rows}
    responses = [r for r in got if r.record_type == "response"]
    assert len(got) == len(rows)
    whole = {(r.record_id, bytes(r.payload)) for r in responses}
    for record_id, payload in whole:
        assert any(f"<urn:page:{'' if i is None else i}>" == record_id and payload == p for i, _, p in want)


def test_archives_are_plain_gzip(spark, tmp_path):
    folder = tmp_path / "archive"
    pages = spark.createDataFrame(page_rows(), PAGE_SCHEMA).coalesce(1)
    warc.write_archives(pages, str(folder))
    (file,) = folder.glob("part-*")
    raw = gzip.decompress(file.read_bytes())
    # One page is a record itself.
    assert raw.count(b"WARC/1.1\r\nWARC-Type: ") == len(page_rows()) + 1
    assert file.read_bytes()[:3] == warc.MAGIC


def test_foreign_archives_and_false_magic(spark, tmp_path):
    """Members without padding, magic bytes within payloads, and a nested archive."""
    inner = warc.record(7, "http://in", b"inner", "response", None)
    payloads = [b"\x1f\x8b\x08" * 50, random.Random(1).randbytes(5000), b"plain"]
    members = [warc.record(i, f"http://o/{i}", p, "response", None) for i, p in enumerate(payloads)]
    folder = tmp_path / "foreign"
    folder.mkdir()
    (folder / "a.warc.gz").write_bytes(b"".join(members) + gzip.compress(b"not a record") + inner)
    got = warc.read_archives(spark, str(folder), range_bytes=100)
    assert sorted(bytes(r.payload) for r in got.collect()) == sorted([*payloads, b"inner"])


def test_damage_is_an_error(spark, tmp_path):
    member = bytearray(warc.record(1, "http://o", b"x" * 3000, "response", None))
    folder = tmp_path / "damaged"
    folder.mkdir()
    (folder / "a.warc.gz").write_bytes(bytes(member[:-20]))
    with pytest.raises(Exception, match="truncated|incorrect|damaged"):
        warc.read_archives(spark, str(folder)).collect()


def test_empty_table(spark):
    none = spark.createDataFrame([], PAGE_SCHEMA)
    assert warc.round_trip(none).collect() == []


def test_clashing_columns(spark):
    pages = spark.createDataFrame(page_rows(), PAGE_SCHEMA).selectExpr(
        "*", "'x' AS record_type", "1 AS refers_to", "2 AS path"
    )
    assert cases.tuples(warc.round_trip(pages), *NAMES) == expected(page_rows())
