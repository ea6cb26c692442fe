"""Run artifacts: nested JSON with ``metadata`` and ``results[]``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from planlens.schemas import RUN_ARTIFACT_SCHEMA


_CORRUPT = "_corrupt_record"


def _read(spark: SparkSession, path: str, multi_line: bool) -> DataFrame:
    schema = StructType([*RUN_ARTIFACT_SCHEMA.fields, StructField(_CORRUPT, StringType())])
    return spark.read.schema(schema).json(
        path, multiLine=multi_line, mode="PERMISSIVE", columnNameOfCorruptRecord=_CORRUPT
    )


def read_run_artifacts(spark: SparkSession, path: str, *, multi_line: bool = True) -> DataFrame:
    """One row per artifact in the files under ``path``: a file is one artifact, however many
    lines it has, or, without ``multi_line``, holds one per line, so that a large file is
    split over many tasks. Those that can't be parsed are ``corrupt_run_artifacts``."""
    good = _read(spark, path, multi_line).where(F.col(_CORRUPT).isNull())
    return good.select(*RUN_ARTIFACT_SCHEMA.names)


def corrupt_run_artifacts(spark: SparkSession, path: str, *, multi_line: bool = True) -> DataFrame:
    """(file, text) of what is no artifact."""
    found = _read(spark, path, multi_line)
    # An artifact that parses has results; to name a parsed column lets Spark read the other.
    return found.where(F.col(_CORRUPT).isNotNull() & F.col("results").isNull()).select(
        F.col("_metadata.file_path").alias("file"), F.col(_CORRUPT).alias("text")
    )


def parse_run_artifacts(documents: DataFrame, column: str = "document") -> DataFrame:
    """One row per artifact held as text in ``column``."""
    return documents.select(
        F.from_json(column, RUN_ARTIFACT_SCHEMA).alias("artifact")
    ).select("artifact.*")
