"""Connected components by alternating large-star and small-star steps.

Kiveris et al., "Connected Components in MapReduce and Beyond", 2014. Every step is one
grouping and one join; the edges are stored between steps, so lineage stays short.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from planlens.session import settle


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("low"))
    return both.where(F.col("b") > F.col("a")).join(least, "a").select(
        F.col("b").alias("a"), F.col("low").alias("b")
    ).where("a != b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("low"))
    return (
        down.join(least, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        .union(least.select("a", F.col("low").alias("b")))
        .where("a != b").distinct()
    )


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count("*").alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x"),
        F.bit_xor(F.xxhash64("b", "a")).alias("y"),
    ).first()
    return tuple(row)


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of an edge; the root is the component's least node.

    ``edges`` has columns a and b of one orderable type, without nulls. Loops and repeated
    edges do no harm. Without edges the result is empty.
    """
    edges = settle(edges.select("a", "b").where("a != b").distinct())
    state = _state(edges)
    while True:
        edges = settle(_small_star(_large_star(edges)))
        now = _state(edges)
        if now == state:
            break
        state = now
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.union(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
