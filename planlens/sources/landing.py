"""Land text extracts as they come: every column text, no deduplication, no
coercion, plus when, from which file and in which batch each row was loaded."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from planlens.schemas import RAW_SCHEMAS, SOURCE_TABLES
from planlens.sources.publish import Warehouse


@dataclass(frozen=True)
class Batch:
    """One load run, shared by every table it lands."""

    batch_id: str = field(default_factory=lambda: uuid.uuid4().hex)
    loaded_at: datetime = field(default_factory=lambda: datetime.now(timezone.utc))


def stamp_metadata(
    df: DataFrame, *, loaded_at: Column, source_file: Column, batch_id: Column
) -> DataFrame:
    return df.withColumns(
        {"_loaded_at": loaded_at, "_source_file": source_file, "_batch_id": batch_id}
    )


def read_extract(
    spark: SparkSession, data_dir: str, file_name: str, *, multi_line: bool = False
) -> DataFrame:
    """One extract, all text. A missing file or a header that is not the
    contract's is an error; a blank cell arrives as NULL.

    ``multi_line`` admits line breaks inside quoted cells; a file then can't be split, so
    a large extract with such cells should come as a folder of files.
    """
    path = f"{data_dir.rstrip('/')}/{file_name}"
    schema = RAW_SCHEMAS[SOURCE_TABLES[file_name]]
    # A quote inside a quoted cell is doubled; a backslash is just text.
    reader = spark.read.options(
        header=True, mode="FAILFAST", escape='"', multiLine=multi_line
    )
    header = reader.csv(path).columns
    if header != schema.names:
        raise ValueError(f"{file_name}: header {header} is not {schema.names}")
    # An extract may be a folder of files: every one's header is held to the schema.
    return reader.schema(schema).option("enforceSchema", False).csv(path)


def land_raw(
    spark: SparkSession,
    data_dir: str,
    warehouse: Warehouse,
    batch: Batch | None = None,
    *,
    multi_line: Sequence[str] = (),
    layer: str = "raw",
) -> dict[str, int]:
    """Replace every raw table from its extract; row counts by table.

    All extracts are read to their ends and written beside the present tables before any of
    those is replaced: one that is missing, foreign or malformed leaves all four of the
    previous load in place. ``multi_line`` names the files with line breaks in cells.
    """
    batch = batch or Batch()
    extracts = {
        table: stamp_metadata(
            read_extract(
                spark, data_dir, file_name, multi_line=file_name in multi_line
            ).select("*", "_metadata.file_name"),
            loaded_at=F.lit(batch.loaded_at),
            source_file=F.col("file_name"),
            batch_id=F.lit(batch.batch_id),
        ).drop("file_name")
        for file_name, table in SOURCE_TABLES.items()
    }
    stored = warehouse.replace_all(
        layer, extracts, batch_id=batch.batch_id, loaded_at=batch.loaded_at
    )
    counts = landed_row_counts(dict(zip(extracts, stored)))
    return {row["table_name"]: row["row_count"] for row in counts.collect()}


def landed_row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, row_count) of the landed tables, in one job."""
    counts = [
        df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    union = counts[0]
    for part in counts[1:]:
        union = union.unionByName(part)
    return union
