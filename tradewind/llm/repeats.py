"""Periodic runs of words by seeds on diagonals, extended to their ends."""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD = re.compile(r"[^\x20\x09-\x0D]+")
MIN_LENGTH = 12
# A run of period q and length of at least max(12, 2q) agrees with itself q words on over
# max(12 - q, q) words, so over six at least, and over q where q is six or more.
SEED = MIN_LENGTH // 2

FOUND = "n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"


class Grams:
    """Numbers for the k-grams of one text, equal exactly where the k-grams are.

    ``k`` is six and then doubles, as long as some k-gram repeats. Longer ones come from pairs
    of shorter ones, so nothing is hashed. Each length takes four bytes per word.
    """

    def __init__(self, words: np.ndarray):
        self.words = words
        self.n = len(words)
        self.lengths: list[int] = []
        self.names: list[np.ndarray] = []
        twos = self._joined(words, words, 1)
        fours = self._joined(twos, twos, 2)
        names, k = self._joined(fours, twos, 4), SEED
        while len(names) and int(names.max()) + 1 < len(names):
            self.lengths.append(k)
            self.names.append(names)
            names, k = self._joined(names, names, k), 2 * k

    @staticmethod
    def _joined(left: np.ndarray, right: np.ndarray, shift: int) -> np.ndarray:
        """Names of the pairs that begin at i in ``left`` and at i + ``shift`` in ``right``."""
        size = min(len(left), len(right) - shift)
        if size <= 0:
            return np.empty(0, np.int32)
        pairs = left[:size].astype(np.int64) * (int(right.max()) + 1) + right[shift : shift + size]
        return np.unique(pairs, return_inverse=True)[1].astype(np.int32)

    def agreement(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Number of words from i on that equal those from j on; i below j."""
        i, j = i.copy(), j.copy()
        begin = i.copy()
        # The longest k-gram may fit more than once, each shorter one once at most after it.
        for level in reversed(range(len(self.names))):
            names, k = self.names[level], self.lengths[level]
            todo = np.arange(len(i))
            while len(todo):
                todo = todo[j[todo] < len(names)]
                todo = todo[names[i[todo]] == names[j[todo]]]
                i[todo] += k
                j[todo] += k
        todo = np.arange(len(i))
        while len(todo):
            todo = todo[j[todo] < self.n]
            todo = todo[self.words[i[todo]] == self.words[j[todo]]]
            i[todo] += 1
            j[todo] += 1
        return i - begin


def _spread(first: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """first[0], first[0] + 1, ... for counts[0] numbers, then the same for the others."""
    before = np.cumsum(counts) - counts
    return np.arange(counts.sum()) + np.repeat(first - before, counts)


def seeds(names: np.ndarray, k: int, low: int, high: int) -> np.ndarray:
    """Pairs (lag, i) with low <= lag < high whose k-grams at i and i + lag agree, as lag * size + i.

    Left out are pairs of which both k-grams follow their like by half their length or less:
    those lie in a chain of one period, hence the words before the two agree and the
    pair begins no stretch of its diagonal. The beginnings of all stretches are in. With each
    chain held by its first k-gram the pairs stay in proportion to the text, also where it is
    one word over and over.
    """
    size = len(names) + k
    at = np.argsort(names, kind="stable")
    name = names[at].astype(np.int64)
    place = name * (2 * size) + at
    same = name[1:] == name[:-1]
    repeated = np.zeros(len(at), bool)
    repeated[1:] |= same
    repeated[:-1] |= same
    follows = np.zeros(len(at), bool)
    follows[1:] = same & (np.diff(at) <= k // 2)
    firsts = np.flatnonzero(repeated & ~follows)
    pairs = []
    for sign in (1, -1):
        # All like it that lie low to high - 1 words after, then before, the first of a chain.
        ends = (low, high) if sign == 1 else (1 - high, 1 - low)
        reach = np.clip(at[firsts, None] + np.array(ends), 0, 2 * size - 1)
        left, right = np.searchsorted(place, (name[firsts] * (2 * size))[:, None] + reach).T
        counts = np.maximum(right - left, 0)
        one, other = np.repeat(at[firsts], counts), at[_spread(left, counts)]
        lag = sign * (other - one)
        pairs.append(lag * size + np.minimum(one, other))
    return np.unique(np.concatenate(pairs))


def stretches(grams: Grams) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lag, start and end of the longest agreements of the text with itself, long enough for a run.

    Lags are taken in classes with the k-gram that a run of such a period must repeat: six
    words for lags below twelve, then lags from k to 2k - 1. The seeds of a lag are extended in order;
    the table of furthest covered words holds for each lag the end of its last extension, and
    seeds before it are passed over.
    """
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for level, (names, k) in enumerate(zip(grams.names, grams.lengths, strict=True)):
        size = len(names) + k
        keys = seeds(names, k, 1 if level == 0 else k, min(2 * k, grams.n // 2 + 1))
        if not len(keys):
            continue
        lags = keys // size
        # The next seed of each lag; all lags take a step together.
        following = np.flatnonzero(np.diff(lags, prepend=-1))
        while len(following):
            lag, start = lags[following], keys[following] % size
            covered = start + grams.agreement(start, start + lag)
            out.append((lag, start, covered))
            following = np.searchsorted(keys, lag * size + np.minimum(covered, size - 1))
            inside = following < len(keys)
            following, lag = following[inside], lag[inside]
            following = following[lags[following] == lag]
    if not out:
        none = np.empty(0, np.int64)
        return none, none, none
    lag, start, end = (np.concatenate(part) for part in zip(*out, strict=True))
    enough = end - start >= np.maximum(MIN_LENGTH - lag, lag)
    return lag[enough], start[enough], end[enough]


def _prime_factors(number: int) -> list[int]:
    found, p = [], 2
    while p * p <= number:
        if number % p == 0:
            found.append(p)
            while number % p == 0:
                number //= p
        p += 1
    return found + [number] if number > 1 else found


def runs(words: np.ndarray) -> np.ndarray:
    """All runs of numbered words: rows of start, length and smallest period, by start and period.

    A stretch whose lag is a multiple of a smaller period belongs to that period's run. As it
    is at least twice its lag long, the smaller period divides the lag.
    """
    if len(words) < MIN_LENGTH:
        return np.empty((0, 3), np.int64)
    grams = Grams(words)
    lag, start, end = stretches(grams)
    length = end + lag - start
    smallest = np.ones(len(lag), bool)
    distinct, which = np.unique(lag, return_inverse=True)
    tests = [(at, q // p) for at, q in enumerate(distinct.tolist()) for p in _prime_factors(q)]
    if tests:
        of_lag = np.argsort(which, kind="stable")
        first = np.searchsorted(which[of_lag], np.arange(len(distinct) + 1))
        place = np.array([at for at, _ in tests])
        counts = first[place + 1] - first[place]
        row = of_lag[_spread(first[place], counts)]
        shorter = np.repeat(np.array([s for _, s in tests]), counts)
        repeats = grams.agreement(start[row], start[row] + shorter) >= length[row] - shorter
        smallest[row[repeats]] = False
    found = np.stack([start, length, lag], axis=1)[smallest]
    return found[np.lexsort((found[:, 2], found[:, 0]))]


def scan(text: str) -> tuple[int, list[tuple[int, int, int]], str]:
    """Number of words, runs, and the text with one period of each run left, joined by spaces."""
    words = WORD.findall(text)
    numbers = {word: i for i, word in enumerate(dict.fromkeys(words))}
    coded = np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))
    found = runs(coded)
    if not len(found):
        return len(words), [], " ".join(words)
    # +1 where a repeated part begins, -1 behind it.
    depth = np.zeros(len(words) + 1, np.int64)
    np.add.at(depth, found[:, 0] + found[:, 2], 1)
    np.add.at(depth, found[:, 0] + found[:, 1], -1)
    kept = np.flatnonzero(np.cumsum(depth[:-1]) == 0)
    return len(words), list(map(tuple, found.tolist())), " ".join([words[i] for i in kept])


def _scanned(texts: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([scan(text) for text in texts], columns=["n_words", "runs", "collapsed"])


def periodic_runs(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns, ``n_words``, ``runs`` and ``collapsed`` of every document.

    Words are separated by ASCII white space. A run is a stretch of words with smallest period
    q, at least twelve words and twice q long, that no neighbouring word extends; ``runs`` has
    start (word number), length and period of all, by start and then period. ``collapsed``
    are the words outside the later periods of runs, joined by one space.

    A null or empty text has no words and no runs. Very long texts are searched whole: time
    grows as n log n in the words of a text, memory by four bytes for each word and k-gram
    length that repeats. Repeated rows stay. Columns of ``docs`` that are not kept do not matter,
    so none clashes. An empty table gives an empty table. Documents are searched alone,
    so nothing is shuffled and no key is hot.
    """
    found = F.pandas_udf(_scanned, FOUND)(F.coalesce("text", F.lit("")))
    return docs.select(
        *[F.col(c).alias(f"__keep_{i}") for i, c in enumerate(keep)], found.alias("__found")
    ).select(
        *[F.col(f"__keep_{i}").alias(c) for i, c in enumerate(keep)],
        "__found.n_words",
        "__found.runs",
        "__found.collapsed",
    )


def longest(runs: str = "runs") -> Column:
    """The longest run, of equals the first and then the one of least period; null if there is none."""
    ranked = F.transform(
        F.col(runs),
        lambda r: F.struct((-r["length"]).alias("a"), r["start"].alias("b"), r["period"].alias("c")),
    )
    first = F.array_min(ranked)
    return F.when(
        F.size(F.col(runs)) > 0,
        F.struct(
            first["b"].alias("start"), (-first["a"]).alias("length"), first["c"].alias("period")
        ),
    )
