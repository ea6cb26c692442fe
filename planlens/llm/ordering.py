"""Running totals over a global order, without a task that sees every row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from planlens.session import settle


def placed(df: DataFrame, order: Sequence[str | Column]) -> DataFrame:
    """``df`` range-partitioned by ``order`` and stored, with its partition as ``_part``.

    Stored, because the bounds of a range partitioning come from a sample: every later
    reader must see the same partition numbers, also after an executor was lost.
    """
    ranged = df.repartitionByRange(*order)
    return settle(ranged.withColumn("_part", F.spark_partition_id()))


def running_totals(
    df: DataFrame, by: Sequence[str], order: Sequence[str | Column], totals: dict[str, str]
) -> DataFrame:
    """Sum of each ``totals`` column over the rows before each row, per ``by`` group.

    ``df`` comes from ``placed`` over (``by``, ``order``). Each partition is summed on its
    own; only those sums, one row per partition and group in it, are accumulated. So a hot
    group is spread over as many tasks as it has partitions.
    """
    sums = df.groupBy(*by, "_part").agg(*[F.sum(v).alias(f"_sum_{k}") for k, v in totals.items()])
    before = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(
        *[F.col(b).alias(f"_by_{i}") for i, b in enumerate(by)],
        F.col("_part").alias("_at"),
        *[F.coalesce(F.sum(f"_sum_{k}").over(before), F.lit(0)).alias(f"_off_{k}") for k in totals],
    )
    within = (
        Window.partitionBy(*by, "_part").orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    here = df.select("*", *[
        F.coalesce(F.sum(v).over(within), F.lit(0)).alias(f"_run_{k}") for k, v in totals.items()
    ])
    same = F.col("_part") == F.col("_at")
    for i, b in enumerate(by):
        same &= F.col(b).eqNullSafe(F.col(f"_by_{i}"))
    return here.join(offsets, same).select(
        *df.columns, *[(F.col(f"_run_{k}") + F.col(f"_off_{k}")).alias(k) for k in totals]
    )
