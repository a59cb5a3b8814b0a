"""Main text of web pages: layout rules, and differencing against the page of the nearest URL."""

from __future__ import annotations

import html
import os
import re
from collections import Counter
from urllib.parse import urlsplit

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm.ranks import ranked
from tradewind.llm.rows import hash_pair, stored

# What a line is: page furniture, running text of the article, another block inside the
# article, or a block of a page outside any article.
FURNITURE, PROSE, BLOCK, LOOSE = range(4)

INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q ruby "
    "rb rp rt s samp small span strike strong sub sup time tt u var wbr".split()
)
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
# Elements that end where the next of their kind begins, so they are not kept on the stack.
LEAVES = frozenset("p li dt dd tr td th thead tbody tfoot option optgroup colgroup".split())
PROSE_TAGS = frozenset(
    "p li dt dd td th pre blockquote figcaption caption h1 h2 h3 h4 h5 h6 tr".split()
)
RAW = frozenset("script style noscript template svg math iframe object canvas".split())
FURNITURE_TAGS = frozenset(
    "nav footer aside form button select textarea menu dialog head title".split()
)
MAIN_TAGS = frozenset(("article", "main"))
# Words within class, id and role that mark page furniture.
FURNITURE_WORDS = frozenset(
    "ad ads adbox advert adverts advertisement advertising sponsor sponsored promo promotion "
    "sidebar nav navbar navigation menu menubar breadcrumb breadcrumbs masthead footer contentinfo "
    "complementary cookie cookies consent gdpr notice notices alert popup modal overlay comment "
    "comments commentlist disqus respond reply replies related recommended share sharing social "
    "newsletter subscribe subscription signup login search widget toolbar pagination pager skip "
    "hidden".split()
)
HEADER_WORDS = frozenset(("header", "banner", "topbar"))

TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"""
    r"""|<(/?)([a-zA-Z][^\s/>]*)((?:[^"'>]|"[^"]*"|'[^']*')*)(?:>|\Z)""",
    re.DOTALL,
)
ATTRIBUTE = re.compile(
    r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))|\b(hidden)\b""", re.IGNORECASE
)
WORDS = re.compile(r"[a-z]+")
# Each page is compared with so many pages of its host, of those so many places before and after in the
# order of URLs; the order is cut into blocks of so many pages.
PARTNERS = 16
REACH = 16
BLOCK_PAGES = 256
# A line is shared if so many of the partners have it, or the only partner: a single page
# that has most of the lines may be another version of the same text. Of what looks like furniture one is enough.
VOTES = 2
# Longest common subsequences of this many line pairs are traced at once.
TRACE_CELLS = 1 << 28


def _marks(attributes: str) -> set[str]:
    """Words in the class, id and role of a tag."""
    if not attributes:
        return set()
    found: set[str] = set()
    for _, double, single, bare, hidden in ATTRIBUTE.findall(attributes):
        found.update(WORDS.findall((double or single or bare).lower()))
        if hidden and not (double or single or bare):
            found.add("hidden")
    return found


def lines_of(page: str) -> list[tuple[int, str]]:
    """(kind, text) of all text lines of a page, in page order, white space made single."""
    out: list[tuple[int, str]] = []
    stack: list[tuple[str, bool, bool]] = []  # tag, furniture, main
    # What is open, counted, so that deep nesting costs nothing more.
    tags: Counter[str] = Counter()
    inside = {"furniture": 0, "main": 0, "prose": 0}
    unclosed: set[str] = set()
    parts: list[str] = []
    leaf, leaf_furniture = "", False

    def count(entry: tuple[str, bool, bool], step: int) -> None:
        tag, furniture, main = entry
        tags[tag] += step
        inside["furniture"] += step * furniture
        inside["main"] += step * main
        inside["prose"] += step * (tag in PROSE_TAGS)

    def push(*entry) -> None:
        stack.append(entry)
        count(entry, 1)

    def pop() -> str:
        entry = stack.pop()
        count(entry, -1)
        return entry[0]

    def after(tag: str, at: int, otherwise: int) -> int:
        """Where the element that begins at an offset ends."""
        end = None
        if tag not in unclosed:
            end = re.compile(rf"</{re.escape(tag)}\s*>", re.IGNORECASE).search(page, at)
        if end is None:
            unclosed.add(tag)
        return end.end() if end else otherwise

    def flush() -> None:
        text = " ".join(html.unescape("".join(parts)).split())
        parts.clear()
        if text:
            if leaf_furniture or inside["furniture"]:
                kind = FURNITURE
            elif not inside["main"]:
                kind = LOOSE
            elif leaf in PROSE_TAGS or inside["prose"]:
                kind = PROSE
            else:
                kind = BLOCK
            out.append((kind, text))

    at, n = 0, len(page)
    while at < n:
        token = TOKEN.search(page, at)
        if token is None:
            parts.append(page[at:])
            break
        parts.append(page[at : token.start()])
        at = token.end()
        tag = (token[2] or "").lower()
        if not tag or tag in INLINE:
            if not tag and token[0].startswith("<![CDATA["):
                parts.append(html.escape(token[0][9:].removesuffix("]]>")))
            if tag and not token[1] and tag not in VOID:
                marks = _marks(token[3])
                if marks & FURNITURE_WORDS:
                    # Furniture within a line: skipped up to its end tag.
                    at = after(tag, at, at)
            continue
        closing = bool(token[1])
        if tag == "br":
            parts.append(" ")
            continue
        flush()
        if tag in VOID:
            continue
        if closing:
            if tag in LEAVES or tag == leaf:
                leaf, leaf_furniture = "", False
            elif tags[tag]:
                while pop() != tag:
                    pass
                leaf, leaf_furniture = "", False
            continue
        if tag in RAW:
            at = after(tag, at, n)
            continue
        if token[3].rstrip().endswith("/") and tag not in LEAVES:
            continue
        marks = _marks(token[3])
        in_main = inside["main"] > 0
        furniture = bool(marks & FURNITURE_WORDS) or tag in FURNITURE_TAGS
        if not in_main:
            furniture |= tag == "header" or bool(marks & HEADER_WORDS)
        if tag in LEAVES:
            leaf, leaf_furniture = tag, furniture and tag not in FURNITURE_TAGS
            continue
        if tag in ("html", "body"):
            while stack:
                pop()
            leaf, leaf_furniture = "", False
            continue
        if tag in MAIN_TAGS and not in_main:
            # An unclosed menu or header before the article ends here.
            while stack and stack[-1][0] in ("nav", "header", "form", "ul", "head", "title"):
                pop()
            furniture = False
        leaf, leaf_furniture = "", False
        push(tag, furniture, tag in MAIN_TAGS or "main" in marks)
    flush()
    return out


def _hash(text: str) -> int:
    value = xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass"), 42)
    return value - (1 << 64) if value >> 63 else value


PARSED = (
    "host string, path string, lines array<struct<kind:int,text:string>>, digests array<bigint>"
)


def parsed(urls: pd.Series, pages: pd.Series) -> pd.DataFrame:
    """Host, path and lines of pages."""
    rows = []
    for url, page in zip(urls, pages, strict=True):
        try:
            parts = urlsplit(url)
            host, path = (parts.hostname or "").lower(), parts.path
        except ValueError:
            host, path = "", url
        lines = lines_of(page)
        rows.append((host, path, lines, [_hash(text) for _, text in lines]))
    return pd.DataFrame(rows, columns=["host", "path", "lines", "digests"])


def _vectors(a: list[int], b: list[int]) -> list[int]:
    """Bit vectors of the lengths of common subsequences, one per prefix of ``b``."""
    places: dict[int, int] = {}
    for i, line in enumerate(a):
        places[line] = places.get(line, 0) | 1 << i
    full = (1 << len(a)) - 1
    now, out = full, [full]
    for line in b:
        match = now & places.get(line, 0)
        now = ((now + match) | (now - match)) & full
        out.append(now)
    return out


def _lengths(vector: int, n: int) -> np.ndarray:
    """Length of the common subsequence for each prefix of ``a``, from a bit vector."""
    raw = np.frombuffer(vector.to_bytes(n // 8 + 1, "little"), np.uint8)
    zeros = 1 - np.unpackbits(raw, bitorder="little")[:n].astype(np.int64)
    return np.concatenate([[0], np.cumsum(zeros)])


def common_lines(a: list[int], b: list[int]) -> list[int]:
    """Positions in ``a`` of a longest common subsequence with ``b``.

    Bit-parallel, so it takes len(a) * len(b) / 64 steps; long pairs are halved first
    (Hirschberg), which bounds the memory of the trace.
    """
    start = 0
    while start < min(len(a), len(b)) and a[start] == b[start]:
        start += 1
    end = 0
    while end < min(len(a), len(b)) - start and a[-1 - end] == b[-1 - end]:
        end += 1
    head = list(range(start))
    tail = list(range(len(a) - end, len(a)))
    a, b = a[start : len(a) - end], b[start : len(b) - end]
    shared = set(a) & set(b)
    places = [i for i, line in enumerate(a) if line in shared]
    a = [a[i] for i in places]
    b = [line for line in b if line in shared]
    return head + [start + places[i] for i in _trace(a, b)] + tail


def _trace(a: list[int], b: list[int]) -> list[int]:
    if not a or not b:
        return []
    if len(a) * len(b) > TRACE_CELLS and len(b) > 1:
        half = len(b) // 2
        front = _lengths(_last(a, b[:half]), len(a))
        back = _lengths(_last(a[::-1], b[half:][::-1]), len(a))[::-1]
        cut = int(np.argmax(front + back))
        return _trace(a[:cut], b[:half]) + [cut + i for i in _trace(a[cut:], b[half:])]
    vectors = _vectors(a, b)
    found = []
    i, j = len(a) - 1, len(b)
    while i >= 0 and j > 0:
        if vectors[j] >> i & 1:  # a[i] adds nothing with b[:j]
            i -= 1
        elif not vectors[j - 1] >> i & 1:  # b[j-1] is not needed for it
            j -= 1
        else:
            found.append(i)
            i, j = i - 1, j - 1
    return found[::-1]


def _last(a: list[int], b: list[int]) -> int:
    places: dict[int, int] = {}
    for i, line in enumerate(a):
        places[line] = places.get(line, 0) | 1 << i
    full = (1 << len(a)) - 1
    now = full
    for line in b:
        match = now & places.get(line, 0)
        now = ((now + match) | (now - match)) & full
    return now


def _agreement(a: str, b: str) -> int:
    """Characters that two paths share from the start."""
    return len(os.path.commonprefix((a, b)))


def partners(paths: list[str], at: int, same_host: list[bool]) -> list[int]:
    """The nearest pages to the one at a place of the URL order, nearest first.

    Of ``REACH`` places before and after, on the same host, the ``PARTNERS`` whose paths agree
    longest from the start; of equals the closest, then the one before.
    """
    near = range(max(0, at - REACH), min(len(paths), at + REACH + 1))
    found = [
        (-_agreement(paths[at], paths[i]), abs(i - at), i) for i in near if i != at and same_host[i]
    ]
    return [i for *_, i in sorted(found)[:PARTNERS]]


FLAGS = "__page struct<a:bigint,b:bigint>, shared array<boolean>"


def _differenced(block: pd.DataFrame) -> pd.DataFrame:
    """Shared lines of the pages that a block owns; it also has the pages around them."""
    block = block.sort_values("__rank", ignore_index=True)
    hosts, paths = block["host"].to_numpy(), block["path"].tolist()
    lines = [list(digests) for digests in block["digests"]]
    out = []
    for at in np.flatnonzero(block["own"]).tolist():
        votes = np.zeros(len(lines[at]), np.int64)
        near = partners(paths, at, (hosts == hosts[at]).tolist())
        for other in near:
            votes[common_lines(lines[at], lines[other])] += 1
        kinds = np.array(block["kinds"][at], np.int64)
        flags = votes >= np.where(kinds == FURNITURE, 1, max(1, min(VOTES, len(near))))
        # A sentence of an article that another page has too belongs to both.
        flags &= kinds != PROSE
        out.append((block["__page"][at], flags.tolist()))
    return pd.DataFrame(out, columns=["__page", "shared"])


def nearest_shared(keyed: DataFrame) -> DataFrame:
    """(__page, shared) for pages (__page, host, path, digests, kinds), no two of them with the
    same lines on one host: which lines the nearest pages share, prose of articles left out.

    Pages are sorted by host and path. The order is global and cut into blocks of ``BLOCK_PAGES``
    that overlap by the ``REACH`` of the search, so a host with any number of pages is spread over tasks
    and each page is sent once, and a few at the edges twice.
    """
    order = (F.col("host"), F.col("path"), F.col("__page"))
    placed = stored(ranked(keyed, *order), "urls")
    home = F.floor(F.col("__rank") / BLOCK_PAGES).cast("long")
    reached = F.sequence(
        *[F.floor((F.col("__rank") + r) / BLOCK_PAGES).cast("long") for r in (-REACH, REACH)]
    )
    blocked = placed.withColumn("block", F.explode(reached)).withColumn(
        "own", F.col("block") == home
    )
    columns = ("block", "own", "__rank", "__page", "host", "path", "digests", "kinds")
    return blocked.select(*columns).groupBy("block").applyInPandas(_differenced, FLAGS)


def main_texts(pages: DataFrame, keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """``keep`` columns, ``text`` and the ``lines`` of every page.

    Each page is cut into lines at its block elements. A line is furniture (menus, page headers,
    footers, sidebars, notices, adverts, forms, comments; by element, class, id or role), prose
    of an article (headings, paragraphs, list items, cells, quotations), another block of an
    article, or loose, outside any article. First, lines are aligned with those of the pages of
    the nearest URLs on the host by longest common subsequence, and those that two of them share (or the
    only one there is) are deleted, except prose of an article: a sentence that two articles share belongs to both. Layout settles what that
    leaves open: furniture is deleted, and loose lines count only where a page has no article.

    ``lines`` has (kind, text, shared) in page order; ``shared`` marks those that differencing deletes
    and layout would not. :func:`removed_lines` counts all that each of the two removes. A null or
    empty html has no lines and an empty text. A null url is a host of its own. Pages of one host
    with the same lines, repeated rows among them, count as one page, so copies share one
    text and are not each other's partners. Very long pages are read whole. An empty table gives an
    empty table. Columns that are not kept, but for url and html, do not matter, so none clashes.
    """
    columns = [F.col(f"__keep_{i}").alias(c) for i, c in enumerate(keep)]
    read = _read(pages, keep)
    # Only pages where the flags decide, few as a rule, meet their lines again.
    article = F.exists("kinds", lambda kind: kind.isin(PROSE, BLOCK))
    decides = F.exists(
        F.arrays_zip("kinds", "shared"),
        lambda z: z["shared"] & (z["kinds"] == F.when(article, BLOCK).otherwise(LOOSE)),
    )
    shared = stored(
        _flagged(read).filter(decides).select(F.col("__page").alias("__of"), "shared"), "shared-lines"
    )
    article = F.exists("lines", lambda line: line["kind"].isin(PROSE, BLOCK))
    left_open = F.when(article, BLOCK).otherwise(LOOSE)
    marked = F.transform(
        "lines",
        lambda line, i: F.struct(
            line["kind"].alias("kind"),
            line["text"].alias("text"),
            (F.coalesce(F.get("shared", i), F.lit(False)) & (line["kind"] == left_open)).alias("shared"),
        ),
    )
    stays = F.filter(
        "lines",
        lambda line: (line["kind"] == PROSE) | (~line["shared"] & (line["kind"] == left_open)),
    )
    return (
        read.join(shared, F.col("__page") == F.col("__of"), "left")
        .withColumn("lines", marked)
        .select(
            *columns,
            F.array_join(F.transform(stays, lambda line: line["text"]), " ").alias("text"),
            "lines",
        )
    )


def _read(pages: DataFrame, keep: tuple[str, ...]) -> DataFrame:
    """The parsed pages, stored: kept columns, ``__page`` for what has the same lines on a host."""
    parse = F.pandas_udf(parsed, PARSED)
    columns = [F.col(c).alias(f"__keep_{i}") for i, c in enumerate(keep)]
    names = [f"__keep_{i}" for i in range(len(keep))]
    page = pages.select(
        *columns, parse(F.coalesce("url", F.lit("")), F.coalesce("html", F.lit(""))).alias("page")
    ).select(*names, "page.*")
    a, b = hash_pair(F.col("host"), F.col("digests"))
    return stored(
        page.withColumn("__page", F.struct(a.alias("a"), b.alias("b"))), "pages"
    )


def _flagged(read: DataFrame) -> DataFrame:
    """(__page, kinds, shared) for every different page that has lines."""
    kinds = F.transform("lines", lambda line: line["kind"].cast("byte"))
    narrow = read.filter(F.size("digests") > 0).select(
        "__page", "host", "path", "digests", kinds.alias("kinds")
    )
    # Copies are merged before the shuffle; the first path of them stands for all.
    others = F.struct(F.col("path"), F.col("kinds"), F.col("host"), F.col("digests"))
    unique = narrow.groupBy("__page").agg(F.min(others).alias("one")).select("__page", "one.*")
    flags = nearest_shared(unique).withColumnRenamed("__page", "__of")
    return unique.join(flags, F.col("__page") == F.col("__of")).select("__page", "kinds", "shared")


def removed_lines(pages: DataFrame) -> DataFrame:
    """Lines of different pages by ``kind``: ``lines`` in all, and ``shared``, which
    differencing deletes before layout is looked at."""
    read = _read(pages, ())
    line = F.explode(F.arrays_zip("kinds", "shared")).alias("line")
    names = F.array(*map(F.lit, ("furniture", "prose", "block", "loose")))
    return (
        _flagged(read)
        .select(line)
        .groupBy(F.get(names, F.col("line.kinds").cast("int")).alias("kind"))
        .agg(F.count("*").alias("lines"), F.count_if("line.shared").alias("shared"))
    )
