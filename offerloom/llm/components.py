"""Connected components by alternating large-star and small-star rounds.

Each round is a min per node (combined before the shuffle) and one join back
on the node, so a hub with a third of all edges is a skewed join that adaptive
execution splits, never one group in one task. The rounds' edges are written
to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerloom.llm.common import stored


def _lowest(edges: DataFrame) -> DataFrame:
    low = edges.groupBy("a").agg(F.min("b").alias("low"))
    return edges.join(low.withColumn("low", F.least("a", "low")), "a")


def _print_of(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.expr("bit_xor(xxhash64(a, b))")).first()
    return tuple(row)


def connected_components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """``edges(a, b)`` of an ordered type -> ``(node, root)``, root the least node.

    Self-loops and repeated edges are ignored; NULL ends are dropped. Only
    nodes with an edge appear. An empty input gives an empty result.
    """
    edges = stored(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        "edges",
    )
    seen = _print_of(edges)
    for _ in range(rounds):
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = _lowest(both).where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b")).where("a <> b")
        large = large.distinct()
        low = _lowest(large)
        small = low.select(F.col("b").alias("a"), F.col("low").alias("b")).union(
            low.select("a", F.col("low").alias("b"))
        )
        edges = stored(small.where("a <> b").distinct(), "edges")
        now = _print_of(edges)
        if now == seen:
            root = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
            return root.union(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        seen = now
    raise RuntimeError(f"components did not settle in {rounds} rounds")
