"""Sharding by Karmarkar-Karp differencing of indivisible groups."""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradewind.llm.rows import KEYS, hash_pair, multiplied, stored, with_row_key

SHARDS = 24
ROW_BYTES = 8
# Groups of one task at the lower levels, and of the one task at the top.
BUCKET_GROUPS = 10_000
TOP_GROUPS = 12_000
# Rows of a shard that one task numbers.
SLOT_ROWS = 5_000


def difference(sizes: list[int], shards: int) -> list[int]:
    """A shard for each size by largest differencing.

    Each size starts as a partial partition that holds it in one part. The two partial
    partitions with the largest spread are combined again and again, the largest part of one
    with the smallest of the other, until one is left.
    """
    if not sizes:
        return []
    # Parts are chains of items: head and tail into `follow`, so joining two costs a step.
    follow = [-1] * len(sizes)
    heap = []
    for i, size in enumerate(sizes):
        parts = [(0, -1, -1)] * (shards - 1) + [(size, i, i)]
        heap.append((-size, i, parts))
    heapq.heapify(heap)
    order = len(sizes)
    while len(heap) > 1:
        _, _, one = heapq.heappop(heap)
        _, _, two = heapq.heappop(heap)
        both = []
        for (a, a_head, a_tail), (b, b_head, b_tail) in zip(one, reversed(two), strict=True):
            if a_head < 0:
                both.append((a + b, b_head, b_tail))
            elif b_head < 0:
                both.append((a + b, a_head, a_tail))
            else:
                follow[a_tail] = b_head
                both.append((a + b, a_head, b_tail))
        both.sort(key=lambda part: part[0])
        heapq.heappush(heap, (both[0][0] - both[-1][0], order, both))
        order += 1
    shard_of = [0] * len(sizes)
    for shard, (_, head, _) in enumerate(heap[0][2]):
        while head >= 0:
            shard_of[head] = shard
            head = follow[head]
    return shard_of


def _partition(shards: int):
    """Task body: one bucket's items get a ``part``."""

    def run(items: pd.DataFrame) -> pd.DataFrame:
        items = items.sort_values(["size", "ga", "gb"], ascending=[False, True, True])
        items["part"] = np.array(difference(items["size"].tolist(), shards), "int64")
        return items[["kind", "ga", "gb", "bucket", "size", "part"]]

    return run


PLACED = "kind int, ga long, gb long, bucket long, size long, part long"


def _place(
    items: DataFrame, level: int, shards: int, bucket: int, top: int, last: bool = False
) -> DataFrame:
    """(kind, ga, gb, shard) for items (kind, ga, gb, size); kind is the level they come from."""
    items = stored(items, "items")
    n, total = items.agg(F.count("*"), F.sum("size")).first()
    if last or n <= top:
        return (
            items.withColumn("bucket", F.lit(0).cast("long"))
            .groupBy("bucket")
            .applyInPandas(_partition(shards), PLACED)
            .select("kind", "ga", "gb", F.col("part").alias("shard"))
        )
    # Fewer than a third of `top` items can be larger than this.
    large = F.col("size") * top > F.lit(3 * total)
    # Loose items of each level keep their own size: the finest grains go last into place.
    drawn = F.pmod(F.xxhash64("gb", "ga", F.lit(level)), F.lit(n)) < max(1, top // 6)
    apart = large | drawn | (F.col("kind") < level)
    # As many bundles as the top takes, or more where a bucket would be too large for a task.
    cuts = max(-(-n // bucket), top // 3 // shards, 1)
    placed = stored(
        items.filter(~apart)
        .withColumn("bucket", F.pmod(F.xxhash64("ga", "gb", F.lit(level)), F.lit(cuts)))
        .groupBy("bucket")
        .applyInPandas(_partition(shards), PLACED),
        "bundles",
    )
    bundles = placed.groupBy("bucket", "part").agg(F.sum("size").alias("size"))
    above = items.filter(apart).unionByName(
        bundles.select(
            F.lit(level + 1).alias("kind"),
            F.col("bucket").alias("ga"),
            F.col("part").alias("gb"),
            "size",
        )
    )
    few = cuts * shards <= max(top // 3, shards)
    found = stored(_place(above, level + 1, shards, bucket, top, few), "placed")
    of_bundle = found.filter(F.col("kind") == level + 1).select(
        F.col("ga").alias("bucket"), F.col("gb").alias("part"), "shard"
    )
    return placed.join(of_bundle, ["bucket", "part"]).select("kind", "ga", "gb", "shard").unionByName(
        found.filter(F.col("kind") <= level)
    )


def shard_groups(
    groups: DataFrame,
    shards: int = SHARDS,
    bucket_groups: int = BUCKET_GROUPS,
    top_groups: int = TOP_GROUPS,
) -> DataFrame:
    """(ga, gb, shard) from groups (ga, gb, size); a group is never divided.

    Up to ``top_groups`` groups are differenced at once. More are first brought down: hash
    buckets are differenced side by side, each into as many nearly equal bundles as there are
    shards, and bundles are the items of the next level. Groups too large for a bundle go to
    the top as they are, and so do ``top_groups`` / 6 hashed items of each level, so that it
    can even out what large groups leave uneven. The top takes a third of ``top_groups`` in
    bundles, fewer than that in large groups, and the loose items: no task holds more than a
    bucket or a small multiple of ``top_groups``.
    """
    items = groups.select(F.lit(0).alias("kind"), "ga", "gb", F.col("size").cast("long"))
    return _place(items, 0, shards, bucket_groups, top_groups).select(
        "ga", "gb", F.col("shard").cast("int").alias("shard")
    )


def text_bytes(text: str = "text"):
    """UTF-8 bytes of the text, none for null, plus the constant of a row."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + ROW_BYTES


def assigned(keyed: DataFrame, shards: int = SHARDS, slot_rows: int = SLOT_ROWS) -> DataFrame:
    """Per class of equal rows: keys, ``doc_id``, ``size``, ``text_crc32``, ``__rows``, ``shard``
    and ``__slot``, the first of its consecutive slots.

    ``keyed`` comes from :func:`with_row_key`. Slots of a shard are numbered in hash buckets,
    each of which starts where the ones before it end, so no task numbers a whole shard.
    """
    text = F.coalesce("text", F.lit(""))
    ga, gb = hash_pair(text)
    classes = stored(
        keyed.select(
            *KEYS,
            "doc_id",
            text_bytes().alias("size"),
            F.crc32(text).alias("text_crc32"),
            ga.alias("ga"),
            gb.alias("gb"),
        )
        .groupBy(*KEYS)
        .agg(
            F.count("*").alias("__rows"),
            *[F.first(c).alias(c) for c in ("doc_id", "size", "text_crc32", "ga", "gb")],
        ),
        "classes",
    )
    groups = classes.groupBy("ga", "gb").agg(F.sum(F.col("size") * F.col("__rows")).alias("size"))
    shard_of = stored(shard_groups(groups, shards), "shards")
    placed = stored(classes.join(shard_of, ["ga", "gb"]), "placed")
    largest = placed.groupBy("shard").agg(F.sum("__rows").alias("n")).agg(F.max("n")).first()[0]
    cuts = max(1, -(-(largest or 0) // slot_rows))
    placed = placed.withColumn("__sub", F.pmod(F.xxhash64(*KEYS, F.lit(7)), F.lit(cuts)))
    earlier = Window.partitionBy("shard").orderBy("__sub").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    offsets = (
        placed.groupBy("shard", "__sub")
        .agg(F.sum("__rows").alias("n"))
        .withColumn("__offset", F.sum("n").over(earlier) - F.col("n"))
        .drop("n")
    )
    within = Window.partitionBy("shard", "__sub").orderBy(*KEYS).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    return (
        placed.withColumn("__place", F.sum("__rows").over(within) - F.col("__rows"))
        .join(offsets, ["shard", "__sub"])
        .select(
            *KEYS,
            "doc_id",
            "size",
            "text_crc32",
            "__rows",
            "shard",
            (F.col("__offset") + F.col("__place")).alias("__slot"),
        )
    )


def sharded(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """``docs`` with ``shard`` and ``slot``, gapless from 0 within each shard.

    Rows of equal text share a shard; shards are near equal in bytes as far as the largest
    group of equal texts allows. A null text counts no bytes and goes with the empty ones.
    Rows equal in all columns take consecutive slots. An empty table gives an empty table. Very
    long texts count with all their bytes. Columns named ``shard`` and ``slot`` are replaced; others
    may have any names.
    """
    keyed = with_row_key(docs)
    counts = assigned(keyed, shards).select(
        *KEYS, "__rows", F.col("__rows").alias("__copies"), F.col("shard").alias("__shard"), "__slot"
    )
    return multiplied(keyed, stored(counts, "slots")).select(
        *[f"`{c}`" for c in docs.columns if c not in ("shard", "slot")],
        F.col("__shard").alias("shard"),
        (F.col("__slot") + F.col("__copy")).alias("slot"),
    )


def shard_table(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Per row of ``docs``: doc_id, size, text_crc32, shard and slot, as :func:`sharded` has them.

    Other columns do not matter, so none clashes.
    """
    return assigned(with_row_key(docs), shards).select(
        "doc_id",
        "size",
        "text_crc32",
        "shard",
        F.explode(F.sequence("__slot", F.col("__slot") + F.col("__rows") - 1)).alias("slot"),
    )
