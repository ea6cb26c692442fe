"""Lookups from a large fact side."""

from __future__ import annotations

from pyspark.sql import DataFrame


def lookup(facts: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """``facts LEFT JOIN dim ON key``; ``dim`` must be unique on ``key``.

    The facts are read once. Spark broadcasts a dimension that it measures below
    ``spark.sql.autoBroadcastJoinThreshold``, when planning or, from the size of its
    shuffle, while running. Beyond that both sides shuffle, and AQE splits the partitions of
    hot or missing keys over several tasks.
    """
    return facts.join(dim, key, "left")


def lookups(facts: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """Several ``lookup``s, {key: dimension}."""
    for key, dim in dims.items():
        facts = lookup(facts, dim, key)
    return facts
