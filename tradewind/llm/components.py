"""Connected components over a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm.rows import discard, stored


def _state(edges: DataFrame) -> tuple:
    """Count and order-free digest of an edge list: one row, whatever its size."""
    digest = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
    return tuple(edges.agg(F.count("*"), digest).first())


def _star_step(edges: DataFrame, minima: DataFrame) -> DataFrame:
    """Neighbours of each node beside the least of them; both tables are stored, so
    a node with very many edges is split by the skew handling of the join."""
    return edges.join(minima, "a")


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of the edge list (a, b); root is the least node reachable.

    Alternates large-star and small-star steps (Kiveris et al., 2014) until the edges no
    longer change; then each node points at its root. The rounds grow with the logarithm of
    the longest path. An empty edge list gives an empty table.
    """
    now = stored(
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .filter("a != b")
        .distinct(),
        "edges",
    )
    state = _state(now)
    for _ in range(most_rounds):
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        minima = stored(
            both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")),
            "minima",
        )
        large = stored(
            _star_step(both, minima)
            .filter("b > a")
            .select(F.col("b").alias("a"), F.col("m").alias("b"))
            .distinct(),
            "large",
        )
        least = stored(large.groupBy("a").agg(F.min("b").alias("m")), "least")
        small = (
            _star_step(large, least)
            .filter("b != m")
            .select(F.col("b").alias("a"), F.col("m").alias("b"))
            .unionByName(least.select("a", F.col("m").alias("b")))
            .distinct()
        )
        following = stored(small, "edges")
        for table in (now, minima, large, least):
            discard(table)
        now, before = following, state
        state = _state(now)
        if state == before:
            break
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
