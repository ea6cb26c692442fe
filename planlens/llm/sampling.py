"""Bounded samples of labelled rows for fitting, the same on every run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SLICES = 64


def fold(doc_id: Column, folds: int) -> Column:
    """CRC-32 of the id as text, modulo ``folds``; a null id reads as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % folds


def ids_per_label(labelled: DataFrame, per_label: int) -> DataFrame:
    """(doc_id, label) of at most ``per_label`` rows of each label, by a hash of the id.

    Null labels and ids are left out. Ids with several labels go with the least one.
    The first rows of each of ``SLICES`` slices of a label are found first, so that the task
    that ranks a whole label sees a bounded number of rows however many it has.
    """
    one = labelled.where("label is not null and doc_id is not null")
    one = one.groupBy("doc_id").agg(F.min("label").alias("label"))
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    sliced = one.withColumn("_slice", F.pmod(F.xxhash64("doc_id", F.lit("slice")), F.lit(SLICES)))
    for by in (["label", "_slice"], ["label"]):
        ranked = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
        sliced = sliced.withColumn("_rank", ranked).where(F.col("_rank") <= per_label)
    return sliced.select("doc_id", "label")
