"""Secret scan: patterns, and a battery of randomness tests under false-discovery control."""

from __future__ import annotations

import bisect
import itertools
import math
import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm.rows import stored

# The patterns and least lengths of the three base kinds.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LEAST = {"assign": 12, "access": 18, "hex": 16}
KINDS = ("assign", "access", "hex", "random")
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")

# Runs of characters that encodings use, as long as a base kind at least.
LEAST_RUN = 16
RUN = re.compile(rf"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{{{LEAST_RUN},}}")
# Between a name and its value; at the end of a run it is padding.
EQUALS = re.compile(r"=+(?=[^=])")
# Where a run may be joined from parts: paths and names have these, and so have encodings.
JOINTS = tuple(map(re.compile, ("[/+]+", "[_-]+", "[/+_-]+")))

ENCODINGS = {
    "hex": "0123456789abcdef",
    "HEX": "0123456789ABCDEF",
    "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "lower36": "0123456789abcdefghijklmnopqrstuvwxyz",
    "alnum": "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz",
    "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
    "base64url": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_",
}
# Shares of letters in running English text, in percent, from a to z.
LETTER_PERCENT = (
    8.2, 1.5, 2.8, 4.3, 12.7, 2.2, 2.0, 6.1, 7.0, 0.15, 0.77, 4.0, 2.4,
    6.7, 7.5, 1.9, 0.095, 6.0, 6.3, 9.1, 2.8, 0.98, 2.4, 0.15, 2.0, 0.074,
)
# Written names change between small letters, capitals, digits and marks at this rate at most,
# and neighbouring characters of theirs correlate at least so much in value.
CHANGE = 0.2
CORRELATION = 0.25
FALSE_DISCOVERY = 0.001
BINS_PER_DECADE = 50



def _class_table() -> np.ndarray:
    """Small letter 0, capital 1, digit 2, mark 3."""
    table = np.full(128, 3)
    table[ord("a") : ord("z") + 1] = 0
    table[ord("A") : ord("Z") + 1] = 1
    table[ord("0") : ord("9") + 1] = 2
    return table


CLASS = _class_table()


def _text_moments(alphabet: str) -> tuple[float, float]:
    """Sums of squares and cubes of the character shares that written text has in an alphabet."""
    shares = np.array(
        [LETTER_PERCENT[ord(c.lower()) - ord("a")] if c.isalpha() else 0.0 for c in alphabet]
    )
    # Both cases: text is small letters nearly throughout.
    if any(c.islower() for c in alphabet):
        shares = np.where([c.isupper() for c in alphabet], shares * 0.05, shares)
    shares = shares / shares.sum()
    return float((shares**2).sum()), float((shares**3).sum())


MOMENTS = {name: _text_moments(alphabet) for name, alphabet in ENCODINGS.items()}
PLACE = {
    name: {c: i for i, c in enumerate(alphabet)} for name, alphabet in ENCODINGS.items()
}


def inferred(run: str) -> str | None:
    """The narrowest encoding that has all characters of a run; None for plain numbers."""
    body = run.rstrip("=")
    if not body or body.isdigit():
        return None
    used = set(body)
    return next((name for name in ENCODINGS if used <= PLACE[name].keys()), None)


def _normal_below(z: float) -> float:
    return max(1e-300, 0.5 * math.erfc(-z / math.sqrt(2)))


def uniformity(codes: np.ndarray, encoding: str) -> float:
    """Chance that written text is as uniform over the alphabet as this, by chi-squared."""
    size, n = len(ENCODINGS[encoding]), len(codes)
    counts = np.bincount(codes, minlength=size)
    chi = float((counts.astype(float) ** 2).sum() * size / n - n)
    squares, cubes = MOMENTS[encoding]
    mean = size * (1 - squares) + n * (size * squares - 1)
    spread = math.sqrt(4 * n * size**2 * max(cubes - squares**2, 1e-6) + 2 * (size - 1))
    return _normal_below((chi - mean) / spread)


def runs(classes: np.ndarray) -> float:
    """Chance that a written name changes its kind of character as often as this."""
    n, seen = len(classes) - 1, int((classes[1:] != classes[:-1]).sum())
    if seen <= n * CHANGE:
        return 1.0
    terms = [
        math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1)
        + k * math.log(CHANGE) + (n - k) * math.log(1 - CHANGE)
        for k in range(seen, n + 1)
    ]
    top = max(terms)
    return max(1e-300, min(1.0, math.exp(top) * sum(math.exp(t - top) for t in terms)))


def serial(codes: np.ndarray) -> float:
    """Chance that neighbours in a written name correlate as little as this."""
    a, b = codes[:-1].astype(float), codes[1:].astype(float)
    if a.std() == 0 or b.std() == 0:
        return 1.0
    r = float(np.corrcoef(a, b)[0, 1])
    return _normal_below((r - CORRELATION) * math.sqrt(len(codes)))


def battery(run: str) -> float | None:
    """Fisher's combination of the three tests, in log10; None where no encoding fits."""
    encoding = inferred(run)
    if encoding is None:
        return None
    body = run.rstrip("=")
    places = PLACE[encoding]
    codes = np.array([places[c] for c in body])
    classes = CLASS[np.frombuffer(body.encode("ascii"), np.uint8)]
    # One character repeated tells nothing but that it is not random.
    if len(set(body)) < 6:
        return 0.0
    half = -sum(map(math.log, (uniformity(codes, encoding), runs(classes), serial(codes))))
    return (-half + math.log(1 + half + half * half / 2)) / math.log(10)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, end, kind) of the base matches, by start and then kind."""
    found = []
    lowered = text.lower()
    if any(word in lowered for word in KEYWORDS):
        found += [
            (*m.span(), 0) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]
        ]
    if "AKIA" in text:
        found += [
            (*m.span(), 1)
            for m in ACCESS.finditer(text)
            if m.end() - m.start() >= LEAST["access"]
        ]
    return found


def _pieces(cuts: re.Pattern, text: str, start: int, end: int) -> list[tuple[int, int]]:
    """What is left between the cuts, if long enough to be tested."""
    edges = [start, *(edge for m in cuts.finditer(text, start, end) for edge in m.span()), end]
    return [(a, b) for a, b in zip(edges[::2], edges[1::2]) if b - a >= LEAST_RUN]


def tests_of(text: str, start: int, end: int) -> list[tuple[int, int, float]]:
    """Tested parts (start, end, log10 p) of one run, which do not overlap.

    A run may be one secret, or a name or path with a secret in it. So the whole is tested and
    its parts at each kind of joint, and the way that holds the least likely part counts. For the choice, its
    p-values are multiplied by the number of tests made (Bonferroni).
    """
    ways = [[(start, end)]]
    ways += [w for cuts in JOINTS if (w := _pieces(cuts, text, start, end)) not in (ways[0], [])]
    tested = {part: battery(text[slice(*part)]) for way in ways for part in way}
    fitting = [[p for p in way if tested[p] is not None] for way in ways]
    best = min(filter(None, fitting), key=lambda way: min(map(tested.get, way)), default=[])
    made = math.log10(max(1, sum(p is not None for p in tested.values())))
    return [(*part, min(0.0, tested[part] + made)) for part in best]


def scan(text: str) -> tuple[list, list]:
    """Base spans (start, end, kind) and tested parts of runs (start, end, log10 p) of a whole text.

    Of a run, all that lies outside base spans is tested, cut at equals signs that are no padding.
    """
    found = base_spans(text)
    runs_ = [m.span() for m in RUN.finditer(text)]
    # Hexadecimal runs of the least length lie within runs of the wider alphabet.
    for start, end in runs_:
        found += [
            (*m.span(), 2)
            for m in HEX.finditer(text, start, end)
            if m.end() - m.start() >= LEAST["hex"]
        ]
    found.sort(key=lambda f: (f[0], f[2], f[1]))
    starts = [start for start, _, _ in found]
    reach = list(itertools.accumulate((end for _, end, _ in found), max))
    tested = []
    for start, end in runs_:
        at = start
        # From the first base span that reaches into the run to the last that begins in it.
        for i in range(bisect.bisect_right(reach, start), bisect.bisect_left(starts, end)):
            for piece in _pieces(EQUALS, text, at, max(at, min(starts[i], end))):
                tested += tests_of(text, *piece)
            at = max(at, found[i][1])
        for piece in _pieces(EQUALS, text, at, max(at, end)):
            tested += tests_of(text, *piece)
    return found, tested


FOUND = (
    "base array<struct<start:int,end:int,kind:int>>, "
    "tested array<struct<start:int,end:int,p:double>>"
)


def scanned(texts: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([scan(text) for text in texts], columns=["base", "tested"])


def discovery_limit(tests: DataFrame, rate: float) -> float:
    """The largest weighted log10 p that Benjamini and Hochberg's step-up rule accepts.

    ``tests`` has (length, p). Each test weighs in proportion to its length, weights averaging
    1 over all tests, so long runs, whose tests have more power, need less. Tests are counted
    in fine bins of the weighted p; the bins, not the tests, come to the driver.
    """
    n, length = tests.agg(F.count("*"), F.avg("length")).first()
    if not n:
        return -math.inf
    weighted = F.col("p") - F.log10(F.col("length") / F.lit(length))
    # A bin stands for its upper edge, which errs on the careful side.
    bins = (
        tests.select(F.ceil(F.greatest(weighted, F.lit(-330.0)) * BINS_PER_DECADE).alias("bin"))
        .groupBy("bin")
        .count()
        .collect()
    )
    limit, below = -math.inf, 0
    for at, count in sorted(map(tuple, bins)):
        below += count
        if at / BINS_PER_DECADE <= math.log10(rate * below / n):
            limit = at / BINS_PER_DECADE
    return limit


def secret_spans(
    docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), rate: float = FALSE_DISCOVERY
) -> DataFrame:
    """``keep`` columns, ``base`` and ``spans`` of every document.

    Both are arrays of (start, end, kind), code points with exclusive end, by start and then
    kind as in ``KINDS``. ``base`` has the pattern matches; ``spans`` adds kind ``random``: parts
    of 16 or more characters of an encoding, outside all base spans, that written text is too
    unlikely to have made. A run is cut at equals signs that are no padding, and tested whole and in parts
    at ``/``, ``+``, ``-`` and ``_``. For each part the narrowest encoding is inferred and three tests are
    combined by Fisher's method; over all parts of all documents the share of false ones among
    those added is held at ``rate``. A null text is empty; texts without matches have empty
    arrays; very long texts are scanned whole; repeated rows stay; an empty table gives an empty table.
    Columns that are not kept do not matter, so none clashes. Plain numbers are not
    tested: their digits are uniform without being secret.
    """
    text = F.coalesce("text", F.lit(""))
    found = stored(
        docs.select(
            *[F.col(c).alias(f"__keep_{i}") for i, c in enumerate(keep)],
            F.pandas_udf(scanned, FOUND)(text).alias("found"),
        ).select(*[f"__keep_{i}" for i in range(len(keep))], "found.*"),
        "secrets",
    )
    tests = found.select(F.explode("tested").alias("t")).select(
        (F.col("t.end") - F.col("t.start")).alias("length"), "t.p"
    )
    length, = tests.agg(F.avg("length")).first()
    limit = discovery_limit(tests, rate)
    passed = F.transform(
        F.filter(
            "tested",
            lambda t: t["p"] - F.log10((t["end"] - t["start"]) / F.lit(length or 1.0))
            <= F.lit(limit),
        ),
        lambda t: F.struct(
            t["start"].alias("start"), t["end"].alias("end"), F.lit(3).alias("kind")
        ),
    )
    in_order = lambda a, b: (
        F.when(a["start"] != b["start"], a["start"] - b["start"])
        .when(a["kind"] != b["kind"], a["kind"] - b["kind"])
        .otherwise(a["end"] - b["end"])
    )
    return found.select(
        *[F.col(f"__keep_{i}").alias(c) for i, c in enumerate(keep)],
        "base",
        F.array_sort(F.concat("base", passed), in_order).alias("spans"),
    )


def spelled(spans: str):
    """kind:start:end of all spans, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(
                ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string")
            ),
        ),
        ",",
    )


def of_kind(kind: str, spans: str = "base"):
    at = KINDS.index(kind)
    return F.size(F.filter(spans, lambda s: s["kind"] == at)).cast("long")
