"""WARC archives: a writer, and a splittable reader of gzip members."""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import pandas as pd
from pyarrow import fs as arrow_fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.llm.rows import stored
from tradewind.session import scratch_dir

MIN_REVISIT_BYTES = 1000
RANGE_BYTES = 16 * 1024 * 1024
READ_BYTES = 1 << 20
MEMBER_BYTES = 1 << 15
# Enough of a member to see whether it begins as a WARC record does.
PROBE_BYTES = 4096
MAGIC = b"\x1f\x8b\x08"
VERSION = b"WARC/1.1\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
# Archives carry no time of their own here, and equal input gives equal bytes.
DATE = "2020-01-01T00:00:00Z"
FIELD = re.compile(rb"^([^:\r\n]+):[ \t]*(.*)$")


def _clean(value: str) -> str:
    """A header value on one line."""
    return re.sub(r"[\r\n]+", " ", value)


def record(
    page_id: int | None, url: str | None, payload: bytes, kind: str, refers_to: int | None
) -> bytes:
    """One WARC record as a gzip member of its own.

    A revisit has the HTTP header, and with it the length of the full payload, but no payload.
    """
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    block = http + payload if kind == "response" else http
    head = [
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Date: {DATE}",
        "Content-Type: application/http; msgtype=response",
        f"WARC-Payload-Digest: sha1:{digest}",
    ]
    if url is not None:
        head.append(f"WARC-Target-URI: {_clean(url)}")
    if kind == "revisit":
        head.append(f"WARC-Profile: {REVISIT_PROFILE}")
        head.append(f"WARC-Refers-To: <urn:page:{refers_to}>")
    head.append(f"Content-Length: {len(block)}")
    raw = VERSION + "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(raw) + packer.flush()


def with_revisits(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """``pages`` with ``__type`` and ``__refers_to``.

    Of pages with equal payloads of at least ``min_bytes`` bytes the largest page_id is the
    response; the others revisit it. Rows that repeat the largest id are responses too. Only
    digests of payloads that occur under two ids are shuffled and joined.
    """
    payload = F.coalesce(F.encode("html", "UTF-8"), F.lit(b""))
    sized = pages.withColumn("__payload", payload).withColumns(
        {"__bytes": F.length("__payload"), "__sha1": F.sha1("__payload")}
    )
    repeated = stored(
        sized.filter(F.col("__bytes") >= min_bytes)
        .groupBy(F.col("__sha1").alias("__same"))
        .agg(F.max("page_id").alias("__first"), F.count("*").alias("__n"))
        .filter("__n > 1 AND __first IS NOT NULL")
        .select("__same", "__first"),
        "revisits",
    )
    found = (F.col("__sha1") == F.col("__same")) & (F.col("__bytes") >= min_bytes)
    revisit = F.col("__first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("__first"))
    return (
        sized.join(repeated, found, "left")
        .withColumn("__type", F.when(revisit, "revisit").otherwise("response"))
        .withColumn("__refers_to", F.when(revisit, F.col("__first")))
    )


def write_archives(pages: DataFrame, folder: str, min_bytes: int = MIN_REVISIT_BYTES) -> None:
    """One WARC record per page under ``folder``.

    Spark's text writer puts down the members' bytes, so files appear through its commit
    protocol on any file system that Spark writes, and a repeated task leaves no doubles. The
    line separator is a zero byte: padding between gzip members, which readers skip.
    A null html is an empty payload, a null id or url is left out of the record.
    """

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            whole = lambda v: None if pd.isna(v) else int(v)
            yield pd.DataFrame(
                {
                    "member": [
                        record(whole(i), u, bytes(p), k, whole(r))
                        for i, u, p, k, r in batch.itertuples(index=False)
                    ]
                }
            )

    rows = with_revisits(pages, min_bytes).select(
        F.col("page_id").cast("string").alias("page_id"),
        "url",
        "__payload",
        "__type",
        F.col("__refers_to").cast("string").alias("refers_to"),
    )
    members = rows.mapInPandas(pack, "member binary")
    members.select(F.col("member").cast("string")).write.option("lineSep", "\x00").text(folder)


def archive_ranges(spark: SparkSession, folder: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(path, start, end): byte ranges that cover all files, by name and length only."""
    files = (
        spark.read.format("binaryFile")
        .load(folder)
        .select("path", "length")
        .filter("length > 0")
    )
    ranges = files.select(
        "path",
        "length",
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(range_bytes))).alias(
            "start"
        ),
    ).select("path", "start", F.least("length", F.col("start") + range_bytes).alias("end"))
    # A task per range, as far as the hash deals them apart.
    tasks = ranges.count()
    return ranges.repartition(max(1, tasks), "path", "start")


def open_file(path: str):
    """A seekable stream; local paths and any store that Arrow's file systems reach."""
    if path.startswith("file:"):
        return open("/" + path.removeprefix("file:").lstrip("/"), "rb")  # noqa: SIM115
    if "://" not in path:
        return open(path, "rb")  # noqa: SIM115
    system, name = arrow_fs.FileSystem.from_uri(path)
    return system.open_input_file(name)


def is_record(start: bytes) -> bool:
    """Whether bytes that look like gzip magic begin a member whose content is a WARC record."""
    if len(start) < 18 or start[:3] != MAGIC or start[3] & 0xE0:
        return False
    try:
        head = zlib.decompressobj(31).decompress(start, 512)
    except zlib.error:
        return False
    return head.startswith(b"WARC/") and b"\r\n" in head


class Window:
    """Reads a stream in large pieces and serves small ones from the last of them."""

    def __init__(self, stream):
        self.stream, self.at, self.data = stream, 0, b""

    def read(self, at: int, n: int) -> bytes:
        """Up to ``n`` bytes from an offset."""
        off = at - self.at
        if off < 0 or off + n > len(self.data):
            self.stream.seek(at)
            self.data, self.at, off = self.stream.read(max(n, READ_BYTES)), at, 0
        return self.data[off : off + n]


def _find(window: Window, at: int, end: int) -> int | None:
    """Offset of the first record's member that starts in [at, end)."""
    # Mostly it follows at once, or after the padding.
    next_to = window.read(at, PROBE_BYTES)
    start = next_to.lstrip(b"\x00")
    near = at + len(next_to) - len(start)
    if near < end and is_record(start):
        return near
    while at < end:
        # Magic and probe may reach over the edge of what is read at a time.
        stop = min(READ_BYTES, end - at)
        piece = window.read(at, stop + PROBE_BYTES)
        place = piece.find(MAGIC)
        while 0 <= place < stop:
            if is_record(piece[place : place + PROBE_BYTES]):
                return at + place
            place = piece.find(MAGIC, place + 1)
        at += stop
    return None


def _member(window: Window, at: int) -> tuple[bytes, int]:
    """The content of the member at an offset, and the offset behind it."""
    unpack = zlib.decompressobj(31)
    parts = []
    while not unpack.eof:
        piece = window.read(at, MEMBER_BYTES)
        if not piece:
            raise ValueError(f"truncated gzip member at byte {at}")
        at += len(piece)
        parts.append(unpack.decompress(piece))
    return b"".join(parts), at - len(unpack.unused_data)


def parse_record(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields in lower case and the block of a record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = {}
    for line in head.split(b"\r\n")[1:]:
        if match := FIELD.match(line):
            fields[match[1].decode().lower()] = match[2].decode("utf-8", "replace").strip()
    length = int(fields.get("content-length", "0"))
    if len(rest) < length:
        raise ValueError("record is shorter than its Content-Length")
    return fields, rest[:length]


def _row(path: str, offset: int, raw: bytes) -> tuple:
    fields, block = parse_record(raw)
    http, _, payload = block.partition(b"\r\n\r\n")
    kind = fields.get("warc-type")
    said = fields.get("warc-payload-digest", "")
    digest = base64.b32decode(said[5:]).hex() if said.startswith("sha1:") else None
    declared = re.search(rb"(?mi)^content-length:[ \t]*(\d+)", http)
    size = int(declared[1]) if declared else len(payload)
    if kind == "response":
        actual = hashlib.sha1(payload).hexdigest()
        if digest not in (None, actual) or size != len(payload):
            raise ValueError(f"payload of the record at {path}:{offset} is damaged")
        digest = actual
    return (
        path,
        offset,
        kind,
        fields.get("warc-record-id"),
        fields.get("warc-target-uri"),
        fields.get("warc-refers-to"),
        size,
        digest,
        payload,
    )


RECORD = (
    "path string, offset long, record_type string, record_id string, url string, "
    "refers_to string, payload_bytes long, payload_digest string, payload binary"
)
RECORD_NAMES = [part.split()[0] for part in RECORD.split(", ")]


def _read_ranges(with_payload: bool, batch_bytes: int = 8 << 20):
    """Task body: ranges in, the records that start inside them out.

    A record that crosses the end of its range is read on past it; one that began before
    belongs to an earlier range. Members follow each other, so only the first has to be found;
    after damage or padding the search goes on.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, start, end in batch.itertuples(index=False):
                with open_file(path) as stream:
                    window = Window(stream)
                    rows, held, at = [], 0, start
                    while at < end and (at := _find(window, at, end)) is not None:
                        raw, following = _member(window, at)
                        row = _row(path, at, raw)
                        rows.append(row if with_payload else (*row[:-1], None))
                        held, at = held + len(raw), following
                        if held > batch_bytes:
                            yield pd.DataFrame(rows, columns=RECORD_NAMES)
                            rows, held = [], 0
                    if rows:
                        yield pd.DataFrame(rows, columns=RECORD_NAMES)

    return run


def read_archives(
    spark: SparkSession,
    folder: str,
    range_bytes: int = RANGE_BYTES,
    with_payload: bool = True,
) -> DataFrame:
    """All WARC records of gzipped archives in a folder, one row each.

    Files may be of any size: tasks take byte ranges, look for gzip magic, check a candidate by
    decoding its header, and own the records that start in their range. The payload of a
    response is checked against its digest; damage raises an error.
    """
    return archive_ranges(spark, folder, range_bytes).mapInPandas(
        _read_ranges(with_payload), RECORD
    )


def page_number(record_id: str):
    """The page_id within a record id that :func:`record` has made."""
    return F.regexp_extract(record_id, r"^<urn:page:(-?\d+)>$", 1).try_cast("long")


def round_trip(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """Pages written as archives into the cluster's shared folder and read back.

    An empty table gives an empty table. A null or empty html is an empty payload; very long ones are
    written whole. Columns other than page_id, url and html do not matter, so none clashes.
    """
    spark = pages.sparkSession
    folder = f"{scratch_dir(spark, 'warc')}/archive"
    write_archives(pages, folder, min_bytes)
    return read_archives(spark, folder, with_payload=False).select(
        page_number("record_id").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        page_number("refers_to").alias("refers_to"),
    )
