"""A training corpus from ``documents``, as stages that are each written and read again.

Every stage works on all that the one before it kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from planlens.llm import curriculum, decontaminate, langid, quality_rank, shingle_join
from planlens.llm.queries import training_labels
from planlens.llm.sampling import fold
from planlens.session import settle


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose rank reaches the quantile of all their scores at the share of bad labels."""
    ranking = quality_rank.learn(docs, training_labels(spark, sf_dir, "quality"))
    return quality_rank.keep_good(docs, ranking)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the network knows, with a score of 0.35 or more."""
    labelled = docs.where(fold(F.col("doc_id"), 4) != 2)
    net = langid.learn(docs, labelled.select("doc_id", F.col("lang").alias("label")))
    return langid.keep_known(docs, net)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of copies and near copies, the document with the least id."""
    return shingle_join.keep_one(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages of benchmark items; documents that are mostly such go."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    cleaned = decontaminate.clean(docs, items)
    if "n_chars" in docs.columns:
        cleaned = cleaned.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return cleaned


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The training stream in the order of its positions."""
    return curriculum.mix(docs)


STAGES = [
    ("quality classifier", quality),
    ("language ID", language),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", benchmark),
    ("mixing sources to target weights", mixture),
]

ORACLE_SQL = None  # learnt models have no SQL; tests compare with a brute-force version


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir))
    return docs
