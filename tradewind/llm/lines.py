"""Line dedup with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.llm.rows import hash_pair, stored

SPACE = "[\\x20\\x09-\\x0D]"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
MIN_LENGTH = 40
MIN_DOCUMENTS = 5


def line_key(line: Column) -> Column:
    """Stripped of ASCII white space at both ends, A-Z lower-cased."""
    return F.translate(F.btrim(line, F.lit(" \t\n\x0b\x0c\r")), UPPER, UPPER.lower())


def kept_lines(
    docs: DataFrame,
    keep: tuple[str, ...] = ("doc_id",),
    min_length: int = MIN_LENGTH,
    min_documents: int = MIN_DOCUMENTS,
) -> DataFrame:
    """``keep`` columns, ``n_lines``, ``n_dropped`` and the text ``kept`` of every document.

    Lines are cut at \\n. A key of ``min_length`` code points that ``min_documents`` documents
    hold loses all its lines but those of the largest doc_id holding it. Documents are counted
    by doc_id, so repeated rows count once; rows without id count as one document, smaller
    than any other. A null or empty text is one empty line. If all lines go, the text is empty.
    An empty table gives an empty table. Columns that are not kept do not matter, so none clashes.
    Very long texts are taken whole, in time in proportion to their length.

    Only hashes of the long lines are shuffled, never the lines: 128 bits of the key, the
    document's id and its text's hash. Counting is combined before each shuffle, and the join
    that finds the lines to drop reads two stored tables, so a hot line is split at run time.
    """
    text = F.coalesce("text", F.lit(""))
    a, b = hash_pair(text)
    # The text's hashes in a projection of their own: beside the lines they would be taken per line.
    hashed = docs.select(
        F.col("doc_id").alias("__id"), text.alias("__text"), a.alias("__ta"), b.alias("__tb")
    )
    long_lines = (
        hashed.select(
            "__id",
            "__ta",
            "__tb",
            F.posexplode(F.split("__text", "\n", -1)).alias("__pos", "__line"),
        )
        # The key is no longer than the line, and the cheap test spares most short lines.
        .filter(F.length("__line") >= min_length)
        .withColumn("__key", line_key(F.col("__line")))
        .filter(F.length("__key") >= min_length)
    )
    ka, kb = hash_pair(F.col("__key"))
    found = stored(
        long_lines.select("__id", "__ta", "__tb", "__pos", ka.alias("__ka"), kb.alias("__kb")),
        "lines",
    )
    common = stored(
        found.groupBy("__ka", "__kb", "__id")
        .agg(F.lit(1).alias("one"))
        .groupBy("__ka", "__kb")
        .agg(F.count("*").alias("__documents"), F.max("__id").alias("__last"))
        .filter(F.col("__documents") >= min_documents)
        .select("__ka", "__kb", "__last"),
        "common-lines",
    )
    dropped = (
        found.join(common, ["__ka", "__kb"])
        .filter(~F.col("__id").eqNullSafe(F.col("__last")))
        .groupBy("__id", "__ta", "__tb")
        .agg(F.collect_set("__pos").alias("__dropped"))
    )
    dropped = stored(dropped, "dropped-lines").withColumnsRenamed(
        {"__id": "__drop_id", "__ta": "__drop_a", "__tb": "__drop_b"}
    )
    keyed = docs.select(
        *[F.col(c).alias(f"__keep_{i}") for i, c in enumerate(keep)],
        F.col("doc_id").alias("__id"),
        text.alias("__text"),
        a.alias("__ta"),
        b.alias("__tb"),
    )
    same = (
        F.col("__id").eqNullSafe(F.col("__drop_id"))
        & (F.col("__ta") == F.col("__drop_a"))
        & (F.col("__tb") == F.col("__drop_b"))
    )
    lines = F.split("__text", "\n", -1)
    none = F.array().cast("array<int>")
    # array_except works by hashing, so the cost follows the number of lines.
    stay = F.array_except(F.sequence(F.lit(0), F.size("__lines") - 1), "__dropped")
    return (
        keyed.join(dropped, same, "left")
        .withColumn("__lines", lines)
        .withColumn("__dropped", F.coalesce("__dropped", none))
        .select(
            *[F.col(f"__keep_{i}").alias(c) for i, c in enumerate(keep)],
            F.size("__lines").cast("long").alias("n_lines"),
            F.size("__dropped").cast("long").alias("n_dropped"),
            F.when(F.size("__dropped") == 0, F.col("__text"))
            .otherwise(
                F.array_join(F.transform(stay, lambda i: F.get(F.col("__lines"), i)), "\n")
            )
            .alias("kept"),
        )
    )
