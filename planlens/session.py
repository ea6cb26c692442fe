"""Session settings and lineage cutting."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# ANSI makes strict casts raise, which the plan and cost columns rely on.
# AQE coalesces small shuffle partitions and splits skewed ones at run time.
SETTINGS = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


# Shuffle partitions are sized to about this much data each, so that one fits in
# an executor's memory share; AQE merges the ones that turn out small.
PARTITION_BYTES = 128 * 1024 * 1024
MIN_PARTITIONS = 200


def shuffle_partitions(input_bytes: int) -> int:
    """Partitions for shuffles over ``input_bytes`` of order lines."""
    return max(MIN_PARTITIONS, -(-input_bytes // PARTITION_BYTES))


def folder_bytes(spark: SparkSession, folder: str) -> int:
    """Bytes of all files under ``folder``, as its file system counts them."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return files.getContentSummary(path).getLength()


def build_session(
    app_name: str = "planlens", *, input_bytes: int = 0, **overrides: str
) -> SparkSession:
    """A session with the settings above, its shuffles sized for ``input_bytes``;
    ``overrides`` win (dots as ``__``)."""
    builder = SparkSession.builder.appName(app_name).config(
        "spark.sql.shuffle.partitions", str(shuffle_partitions(input_bytes))
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in overrides.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder the session names (``spark.checkpoint.dir``).

    Only a local session may leave it unset, and gets a temporary folder that goes with the
    session. On a cluster a folder of one machine would not outlive that machine.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if not re.match(r"local(\[|$)", context.master):
            raise RuntimeError(
                "set spark.checkpoint.dir to a folder that the driver and all executors share"
            )
        folder = tempfile.mkdtemp(prefix="planlens-checkpoint-")
        delete_on_exit(spark, folder)
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def delete_on_exit(spark: SparkSession, path: str) -> None:
    """Let the driver's JVM delete ``path`` when it ends, also after a failure."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(place)


def settle(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Several consumers then scan the columns they need instead of recomputing
    ``df``, and a lost executor costs a re-read. The copy lives as long as the session's
    JVM, since results read it when they are used.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/settled/{uuid.uuid4().hex}"
    df.write.parquet(path)
    delete_on_exit(spark, path)
    return spark.read.schema(df.schema).parquet(path)
