"""Quality rules: base counts, and robust multivariate outliers per language and source."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.llm.rows import KEYS, stored, with_row_key

ASCII_SPACE = " \t\n\r\x0b\x0c"
SYMBOLS = "#*$%&|<>"
MARKS = ".,!?;:"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

# Transformed statistics of a text.
NAMES = (
    "log_word_length", "log_symbols", "log_marks", "log_capitals", "log_digits", "variety",
)
D = len(NAMES)
ERRORS = tuple(f"error_{name}" for name in NAMES)
# Share of each group that the estimates rest on; C-steps of every start, and then of the best.
COVERAGE = 0.75
START_STEPS = 2
STEPS = 4
# Groups with fewer documents are pooled per language, and then overall.
MIN_GROUP = 100
# Chance that an ordinary document of a normal distribution is rejected.
TAIL = 1e-3
# Digits come in numbers of about so many.
NUMBER_DIGITS = 10

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
FURTHER = ("n_marks", "n_capitals", "n_digits", "n_distinct")


def repeat_words(ids: np.ndarray) -> int:
    """Words inside a 3-word window that the text has twice or more."""
    if len(ids) < 4:
        return 0
    base = int(ids.max()) + 1
    pairs = np.unique(ids[:-1] * base + ids[1:], return_inverse=True)[1]
    _, windows, found = np.unique(
        pairs[:-1] * base + ids[2:], return_inverse=True, return_counts=True
    )
    repeated = found[windows] > 1
    covered = np.zeros(len(ids), bool)
    for shift in range(3):
        covered[shift : shift + len(repeated)] |= repeated
    return int(covered.sum())


def text_counts(text: str) -> tuple[int, ...]:
    """``COUNTS`` and ``FURTHER`` of one text."""
    words = text.encode("utf-8", "surrogatepass").split()
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
    seen: set[str] = set()
    duplicates = 0
    for line in text.split("\n"):
        if line.strip(ASCII_SPACE):
            duplicates += line in seen
            seen.add(line)
    count = lambda characters: sum(map(text.count, characters))
    # Letters that lower-casing changes, by code point.
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    lowered = text.lower()
    if len(lowered) == len(text):
        lower_points = np.frombuffer(lowered.encode("utf-32-le", "surrogatepass"), "<u4")
        capitals = int((points != lower_points).sum())
    else:
        capitals = sum(c.isupper() for c in text)
    return (
        len(words),
        len(text) - count(ASCII_SPACE),
        count(SYMBOLS),
        duplicates,
        repeat_words(ids),
        count(MARKS),
        capitals,
        count("0123456789"),
        len(numbers),
    )


COUNTED = ", ".join(f"{name} long" for name in (*COUNTS, *FURTHER))


def counted(texts: pd.Series) -> pd.DataFrame:
    return pd.DataFrame(
        [text_counts(text) for text in texts], columns=[*COUNTS, *FURTHER], dtype="int64"
    )


def statistics() -> dict[str, Column]:
    """The transformed statistics as expressions over the counts."""
    words, chars = F.greatest("n_words", F.lit(1)), F.greatest("word_chars", F.lit(1))
    return {
        "log_word_length": F.log(chars / words),
        "log_symbols": F.log(F.col("n_symbols") / words + 0.02),
        "log_marks": F.log(F.col("n_marks") / words + 0.05),
        "log_capitals": F.log(F.col("n_capitals") / chars + 0.02),
        "log_digits": F.log(F.col("n_digits") / chars + 0.02),
        "variety": F.log(F.greatest("n_distinct", F.lit(1)) + 1.0) / F.log(words + 1.0),
    }


def sampling_errors() -> dict[str, Column]:
    """What the length of a text alone makes each statistic vary by, as expressions.

    A short text says little about its rates. Counts vary as independent events do, one more than
    there are, so that the first symbol of a text is no surprise; digits come in whole numbers.
    """
    words, chars = F.greatest("n_words", F.lit(1)), F.greatest("word_chars", F.lit(1))

    def of_rate(count: str, of: Column, offset: float, each: int = 1) -> Column:
        return F.sqrt(each * (F.col(count) + each)) / of / (F.col(count) / of + offset)

    errors = (
        0.5 / F.sqrt(words),
        of_rate("n_symbols", words, 0.02),
        of_rate("n_marks", words, 0.05),
        of_rate("n_capitals", chars, 0.02),
        of_rate("n_digits", chars, 0.02, NUMBER_DIGITS),
        0.15 / F.sqrt(words),
    )
    return dict(zip(ERRORS, errors, strict=True))


def chi2_tail(x: float, freedom: int) -> float:
    """Survival function of the chi-squared distribution with an even number of degrees."""
    half = x / 2
    return math.exp(-half) * sum(half**k / math.factorial(k) for k in range(freedom // 2))


def chi2_point(tail: float, freedom: int) -> float:
    """Where the survival function falls to ``tail``."""
    low, high = 0.0, 1000.0
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if chi2_tail(middle, freedom) > tail else (low, middle)
    return high


# The covariance of the inner part of a normal sample is too small by this factor.
CONSISTENCY = COVERAGE / (1 - chi2_tail(chi2_point(1 - COVERAGE, D), D + 2))
LIMIT = chi2_point(TAIL, D)
PAIRS = [(i, j) for i in range(D) for j in range(i, D)]


def _group_names(usable: DataFrame) -> DataFrame:
    """(lang, source, cluster): which documents are judged together.

    A language and source with ``MIN_GROUP`` documents stand alone; smaller ones are pooled
    per language, and what is still too small, overall. Too few even then: null.
    """
    pairs = stored(
        usable.groupBy("lang", "source").agg(F.count("*").alias("n")), "quality-pairs"
    )
    pooled = (
        pairs.filter(F.col("n") < MIN_GROUP)
        .groupBy(F.col("lang").alias("pool"))
        .agg(F.sum("n").alias("pooled"))
    )
    rest = pooled.filter(F.col("pooled") < MIN_GROUP).agg(F.sum("pooled")).first()[0] or 0
    name = lambda level, *of: F.concat(F.lit(level), F.to_json(F.struct(*of)))
    return stored(
        pairs.join(pooled, F.col("lang").eqNullSafe(F.col("pool")), "left").select(
            "lang",
            "source",
            F.when(F.col("n") >= MIN_GROUP, name("pair ", "lang", "source"))
            .when(F.col("pooled") >= MIN_GROUP, name("language ", "lang"))
            .when(F.lit(rest >= MIN_GROUP), F.lit("rest"))
            .alias("cluster"),
        ),
        "quality-clusters",
    )


SOLVED = "cluster string, start int, mean array<double>, whiten array<double>, volume double"


def _solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sums of one cluster and start per row in; centre, whitening matrix and log determinant out.

    A statistic that hardly varies in the inner part is given the variance that sampling alone
    makes: the least that keeps the matrix regular without calling a single event an outlier.
    """
    for batch in batches:
        rows = []
        for row in batch.itertuples(index=False):
            n = row.n
            mean = np.array([getattr(row, f"s{i}") for i in range(D)]) / n
            cov = np.zeros((D, D))
            for i, j in PAIRS:
                cov[i, j] = cov[j, i] = getattr(row, f"p{i}_{j}") / n - mean[i] * mean[j]
            rows.append((row.cluster, row.start, mean.tolist(), *_whitening(cov, row.floor)))
        yield pd.DataFrame(rows, columns=["cluster", "start", "mean", "whiten", "volume"])


def _whitening(cov: np.ndarray, floor: np.ndarray) -> tuple[list[float], float]:
    """Whitening matrix and log determinant of an inner part's covariance, made consistent."""
    cov = cov * CONSISTENCY
    cov = cov + np.diag(np.maximum(0, np.asarray(floor) - np.diag(cov)) + 1e-9)
    lower = np.linalg.cholesky(cov)
    return np.linalg.inv(lower).ravel().tolist(), float(2 * np.log(np.diag(lower)).sum())


def _distance(mean: Column, whiten: Column) -> Column:
    """Squared Mahalanobis distance of a row's statistics."""
    off = [F.col(name) - mean[i] for i, name in enumerate(NAMES)]
    rows = [
        sum((whiten[i * D + j] * off[j] for j in range(i + 1)), F.lit(0.0)) for i in range(D)
    ]
    return sum((r * r for r in rows), F.lit(0.0))


def scales(vectors: DataFrame) -> DataFrame:
    """Median and half-spread of the statistics per cluster, from counts in fine bins."""
    width = 0.002
    bins = (
        vectors.select(
            "cluster",
            F.explode(
                F.array(
                    *[
                        F.struct(F.lit(i).alias("dim"), F.floor(F.col(n) / width).alias("bin"))
                        for i, n in enumerate(NAMES)
                    ]
                )
            ).alias("at"),
        )
        .groupBy("cluster", "at.dim", "at.bin")
        .agg(F.count("*").alias("n"))
    )

    def summarise(group: pd.DataFrame) -> pd.DataFrame:
        # One cluster's bins: their number is bounded by the range of the statistics.
        middle, spread = np.zeros(D), np.zeros(D)
        for dim, part in group.groupby("dim"):
            part = part.sort_values("bin")
            share = part["n"].cumsum() / part["n"].sum()
            at = lambda q, p=part, s=share: (p["bin"][s >= q].iloc[0] + 0.5) * width
            middle[dim] = at(0.5)
            spread[dim] = (at(0.75) - at(0.25)) / 1.349
        return pd.DataFrame([(group["cluster"].iloc[0], middle.tolist(), spread.tolist())])

    return bins.groupBy("cluster").applyInPandas(
        summarise, "cluster string, middle array<double>, spread array<double>"
    )


def standardised(vectors: DataFrame, scaled: DataFrame) -> DataFrame:
    """Statistics as deviations from their cluster's median, in the spread that a text of that
    length has; errors as the part of that spread's variance that sampling makes."""
    joined = vectors.join(scaled.withColumnRenamed("cluster", "__of"), F.col("cluster") == F.col("__of"), "left")
    columns = {}
    for i, (name, error) in enumerate(zip(NAMES, ERRORS, strict=True)):
        variance = F.pow(F.col("spread")[i], 2) + F.pow(error, 2)
        columns[name] = (F.col(name) - F.col("middle")[i]) / F.sqrt(variance)
        columns[error] = F.pow(error, 2) / variance
    return joined.withColumns(columns).drop("__of", "middle", "spread")


def _starts(vectors: DataFrame) -> DataFrame:
    """Three estimates to start from, per cluster, none of which far rows can pull away.

    Deviations as they are; their correlation when each is bent by tanh; and the covariance of
    directions from the median. One combined aggregation over all vectors.
    """
    columns = [F.col(name) for name in NAMES]
    length = F.sqrt(sum((c * c for c in columns), F.lit(1e-12)))
    ways = {"t": [F.tanh(c) for c in columns], "d": [c / length for c in columns]}
    sums = vectors.groupBy("cluster").agg(
        *[
            F.sum(way[i] * way[j]).alias(f"{key}{i}_{j}")
            for key, way in ways.items()
            for i, j in PAIRS
        ],
        F.array(*[F.avg(error) for error in ERRORS]).alias("floor"),
    )

    names = tuple(ways)

    def start(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for row in batch.itertuples(index=False):
                whitens = [np.eye(D)]
                for key in names:
                    cov = np.zeros((D, D))
                    for i, j in PAIRS:
                        cov[i, j] = cov[j, i] = getattr(row, f"{key}{i}_{j}")
                    scale = np.sqrt(np.maximum(np.diag(cov), 1e-12))
                    # Unit variances, as the deviations have; a little more keeps it regular.
                    unit = cov / np.outer(scale, scale) + 0.05 * np.eye(D)
                    whitens.append(np.linalg.inv(np.linalg.cholesky(unit)))
                rows += [
                    (row.cluster, at, [0.0] * D, whiten.ravel().tolist(), list(row.floor))
                    for at, whiten in enumerate(whitens)
                ]
            yield pd.DataFrame(rows, columns=["cluster", "start", "mean", "whiten", "floor"])

    kind = "cluster string, start int, mean array<double>, whiten array<double>, floor array<double>"
    return stored(sums.mapInPandas(start, kind), "quality-starts")


def _concentrated(vectors: DataFrame, now: DataFrame) -> DataFrame:
    """One C-step of every cluster and start: centre and covariance of the nearest share.

    Two map-side combined aggregations over all vectors. The cut is exact to a bin of two
    percent of the distance.
    """
    by = ("cluster", "start")
    far = vectors.join(now, "cluster").select(
        *by,
        "floor",
        *NAMES,
        F.floor(F.log(_distance(F.col("mean"), F.col("whiten")) + 1e-6) * 50).alias("bin"),
    )
    shares = far.groupBy(*by, "bin").agg(F.count("*").alias("n"))

    def cut(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("bin")
        need = math.ceil(COVERAGE * group["n"].sum())
        edge = group["bin"][group["n"].cumsum() >= need].iloc[0]
        return pd.DataFrame([(group["cluster"].iloc[0], group["start"].iloc[0], edge)])

    edges = stored(
        shares.groupBy(*by).applyInPandas(cut, "cluster string, start int, edge long"),
        "quality-edges",
    )
    sums = (
        far.join(edges, list(by))
        .filter("bin <= edge")
        .groupBy(*by)
        .agg(
            F.count("*").alias("n"),
            F.first("floor").alias("floor"),
            *[F.sum(name).alias(f"s{i}") for i, name in enumerate(NAMES)],
            *[F.sum(F.col(NAMES[i]) * F.col(NAMES[j])).alias(f"p{i}_{j}") for i, j in PAIRS],
        )
    )
    floors = now.select(*by, "floor")
    return stored(sums.mapInPandas(_solve, SOLVED).join(floors, list(by)), "quality-step")


def estimates(vectors: DataFrame) -> DataFrame:
    """Minimum-covariance-determinant centre and whitening matrix per cluster.

    ``vectors`` are :func:`standardised`. From three robust starts, ``START_STEPS`` concentration
    steps are taken: the ``COVERAGE`` share of a cluster's documents nearest the present centre gives the next
    mean and covariance. The start with the least determinant then takes ``STEPS`` more. All are
    map-side combined aggregations over all vectors, so a cluster with a third of all
    rows is never gathered.
    """
    now = _starts(vectors)
    for _ in range(START_STEPS):
        now = _concentrated(vectors, now)
    others = [F.col(c) for c in now.columns if c != "cluster"]
    best = now.groupBy("cluster").agg(
        F.min_by(F.struct(*others), F.struct("volume", "start")).alias("best")
    )
    now = stored(best.select("cluster", "best.*"), "quality-best")
    for _ in range(STEPS):
        now = _concentrated(vectors, now)
    return now.select("cluster", "mean", "whiten")


def judged(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """One row per document: ``keep`` columns, the counts, ``base_failed``, ``distance``, ``kept``.

    A null text counts as empty and fails the base rule. Null languages and sources are values
    of their own. ``distance`` is the squared Mahalanobis distance to the document's cluster, in the
    spread that texts of its length have. Documents beyond the point that a normal distribution
    exceeds with chance ``TAIL`` are rejected. A cluster is a language and source with ``MIN_GROUP``
    documents that pass the base rule; smaller ones are judged with their language's, then
    all small ones together. Where fewer than ``MIN_GROUP`` could be pooled ``distance`` is null, and
    the document is kept. Only documents that pass the base rule enter the estimates. Repeated rows
    count each. An empty table gives an empty table. Very long texts are counted whole. Columns that
    are not kept, but for text, lang and source, do not matter, so none clashes.
    """
    text = F.coalesce("text", F.lit(""))
    counts = docs.select(
        *[F.col(c).alias(f"__keep_{i}") for i, c in enumerate(keep)],
        "lang",
        "source",
        F.pandas_udf(counted, COUNTED)(text).alias("c"),
    ).select(*[f"__keep_{i}" for i in range(len(keep))], "lang", "source", "c.*")
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    )
    every = stored(
        counts.withColumn("base_failed", failed).withColumns(statistics() | sampling_errors()),
        "quality-counts",
    )
    usable = every.filter("NOT base_failed")
    clusters = _group_names(usable)
    named = clusters.withColumnsRenamed({"lang": "__lang", "source": "__source"})
    of_cluster = F.col("lang").eqNullSafe(F.col("__lang")) & F.col("source").eqNullSafe(
        F.col("__source")
    )
    placed = every.join(named, of_cluster, "left").drop("__lang", "__source")
    vectors = placed.filter("NOT base_failed AND cluster IS NOT NULL").select(
        "cluster", *NAMES, *ERRORS
    )
    scaled = stored(scales(vectors), "quality-scales")
    centres = estimates(stored(standardised(vectors, scaled), "quality-vectors"))
    distance = _distance(F.col("mean"), F.col("whiten"))
    return (
        standardised(placed, scaled)
        .join(centres, "cluster", "left")
        .withColumn("distance", distance)
        .withColumn(
            "kept", ~F.col("base_failed") & (F.coalesce("distance", F.lit(0.0)) <= LIMIT)
        )
        .select(
            *[F.col(f"__keep_{i}").alias(c) for i, c in enumerate(keep)],
            *COUNTS,
            "base_failed",
            "distance",
            "kept",
        )
    )


def good_documents(docs: DataFrame) -> DataFrame:
    """The documents that pass; columns and rows otherwise as in ``docs``.

    The verdict depends on the row alone and on its cluster, so equal rows share it.
    """
    columns = docs.columns
    keyed = with_row_key(docs)
    bad = judged(keyed, keep=KEYS).filter("NOT kept").select(*KEYS).distinct()
    return keyed.join(stored(bad, "quality-rejected"), list(KEYS), "left_anti").select(
        *[f"`{c}`" for c in columns]
    )
