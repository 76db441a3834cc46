"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.frames import stored


def _least_neighbour(pairs: DataFrame) -> DataFrame:
    """pairs (u, v) with the least of u and its v. The key is a struct, so both sides of the join are
    shuffles of their own and a node with very many edges can be split (Spark's skew join)."""
    least = pairs.groupBy(F.struct("u").alias("k")).agg(F.least(F.min("v"), F.min("u")).alias("least"))
    return pairs.withColumn("k", F.struct("u")).join(least, "k").select("u", "v", "least")


def _hangs_twice(pairs: DataFrame) -> bool:
    """Whether some node hangs on two others."""
    return not pairs.groupBy("u").agg(F.count("*").alias("n")).filter("n > 1").isEmpty()


def _hangs_deeper(pairs: DataFrame) -> bool:
    """Whether some node hangs on one that hangs itself."""
    hanging = pairs.select(F.struct("u").alias("k")).distinct()
    return not pairs.select(F.struct(F.col("v").alias("u")).alias("k")).join(hanging, "k", "left_semi").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of edges (a, b); the root is the least node that is connected.

    Large-star and small-star rounds: every node hangs its neighbours onto the least one, until no
    node that hangs on another has one hanging on it. The number of rounds grows with the logarithm of
    the longest path.
    """
    pairs = stored(edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    while _hangs_twice(pairs) or _hangs_deeper(pairs):
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _least_neighbour(both).filter("v > u").select(F.col("v").alias("u"), F.col("least").alias("v")).distinct()
        small = _least_neighbour(large)
        hung = small.select("u", F.col("least").alias("v")).unionByName(small.select(F.col("v").alias("u"), F.col("least").alias("v")))
        pairs = stored(hung.filter("u <> v").distinct(), "edges")
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        pairs.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
