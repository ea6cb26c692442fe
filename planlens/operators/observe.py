"""Freshness, cost, job and run telemetry over ordinary log tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from planlens.functions import rules

_STAMP = "yyyy-MM-dd HH:mm:ss"


def load_log(raw_tables: dict[str, DataFrame]) -> DataFrame:
    """Load metadata of every landed table, tagged with the table's name."""
    parts = [
        df.select(F.lit(name).alias("table_name"), "_loaded_at", "_batch_id")
        for name, df in raw_tables.items()
    ]
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    return union


def load_freshness(log: DataFrame) -> DataFrame:
    """Latest load, its batch, and how many batches are on file.

    The batch id breaks ties between loads of the same instant.
    """
    return log.agg(
        F.max("_loaded_at").alias("last_loaded_at"),
        F.max_by("_batch_id", F.struct("_loaded_at", "_batch_id")).alias("latest_batch_id"),
        F.count_distinct("_batch_id").alias("batch_count"),
    )


def _rows(log: DataFrame) -> Column:
    """A log has an entry per landed row, or one per load with its ``row_count``."""
    return F.sum("row_count") if "row_count" in log.columns else F.count("*")


def _instant(as_of: str) -> Column:
    return F.lit(as_of).cast("timestamp")


def freshness_by_source(log: DataFrame, as_of: str) -> DataFrame:
    """Per table: last load, hour boundaries crossed since, batches and rows. The log is that of
    the landed rows (``load_log``) or the warehouse's own of its loads."""
    last = F.max("_loaded_at")
    return (
        log.groupBy("table_name")
        .agg(
            last.alias("last_loaded_at"),
            F.timestamp_diff(
                "HOUR", F.date_trunc("hour", last), F.date_trunc("hour", _instant(as_of))
            ).alias("hours_since_load"),
            F.count_distinct("_batch_id").alias("batches_seen"),
            _rows(log).alias("row_count"),
        )
        .orderBy("table_name")
    )


def freshness_verdict(
    log: DataFrame, as_of: str, warn_after: int = 30, error_after: int = 48
) -> DataFrame:
    """pass, warn or error by the exact age of each table's last load, in hours."""
    seconds = F.timestamp_diff("SECOND", "last_loaded_at", _instant(as_of))
    age = (seconds.cast("decimal(18,0)") / 3600).cast("decimal(18,4)")
    return (
        log.groupBy("table_name")
        .agg(F.max("_loaded_at").alias("last_loaded_at"))
        .select(
            "table_name",
            age.alias("age_hours"),
            rules.freshness_verdict(
                hours=age, warn_after=warn_after, error_after=error_after
            ).alias("verdict"),
        )
    )


def layer_row_counts(layers: dict[tuple[str, str], DataFrame]) -> DataFrame:
    """(layer, table_name, row_count) for every table, in one plan."""
    counts = [
        df.agg(F.count("*").alias("row_count")).select(
            F.lit(layer).alias("layer"), F.lit(table).alias("table_name"), "row_count"
        )
        for (layer, table), df in layers.items()
    ]
    union = counts[0]
    for part in counts[1:]:
        union = union.unionByName(part)
    return union.orderBy("layer", "table_name")


def _within(log: DataFrame, as_of: str, days: int) -> Column:
    """``start_time`` in the ``days`` up to ``as_of``, both ends included. The bounds
    take the column's own type, so that the comparison reaches the scan."""
    end = F.lit(as_of).cast(log.schema["start_time"].dataType)
    return F.col("start_time").between(end - F.make_dt_interval(F.lit(days)), end)


def _of_database(log: DataFrame, database: str | None) -> DataFrame:
    return log if database is None else log.where(F.col("database_name") == database)


def cost_by_day(
    usage: DataFrame, as_of: str, *, days: int = 30, warehouses: Sequence[str] = ()
) -> DataFrame:
    """Credits per warehouse and day; an empty list means every warehouse."""
    if warehouses:
        usage = usage.where(F.col("warehouse_name").isin(list(warehouses)))
    credits = ("credits_used", "credits_used_compute", "credits_used_cloud_services")
    return (
        usage.where(_within(usage, as_of, days))
        .groupBy("warehouse_name", F.to_date("start_time").alias("usage_day"))
        .agg(*[F.sum(c).alias(c) for c in credits])
        .orderBy(F.desc("usage_day"), "warehouse_name")
    )


def recent_jobs(
    history: DataFrame, as_of: str, *, days: int = 7, limit: int = 200, database: str | None = None
) -> DataFrame:
    """The newest jobs of the window, elapsed time in seconds; of one database if named."""
    seconds = (F.col("total_elapsed_time").cast("decimal(18,0)") / 1000).cast("decimal(18,3)")
    return (
        _of_database(history, database)
        .where(_within(history, as_of, days))
        .orderBy(F.desc("start_time"), F.desc("query_id"))
        .limit(limit)
        .select(
            "query_id", "query_type", "user_name", "role_name", "warehouse_name",
            "execution_status", "error_code", "error_message", "start_time",
            seconds.alias("elapsed_seconds"),
        )
    )


def failed_jobs(
    history: DataFrame, as_of: str, *, days: int = 7, database: str | None = None
) -> DataFrame:
    return (
        _of_database(history, database)
        .where((F.col("execution_status") == "FAIL") & _within(history, as_of, days))
        .select("query_id", "query_type", "error_code", "error_message", "start_time")
        .orderBy(F.desc("start_time"), F.desc("query_id"))
    )


def table_stats(
    tables: dict[tuple[str, str], DataFrame], *, catalog: str = "", altered: Column | None = None
) -> DataFrame:
    """Row count and text bytes of whole rows of each table, shaped for ``table_sizes``."""
    altered = F.current_date() if altered is None else altered
    parts = []
    for (schema, name), df in tables.items():
        width = sum(
            (F.coalesce(F.octet_length(F.col(f"`{c}`").cast("string")), F.lit(0))
             for c in df.columns),
            F.lit(0),
        ).cast("bigint")
        parts.append(df.select(width.alias("w")).agg(
            F.lit(catalog).alias("table_catalog"),
            F.lit(schema).alias("table_schema"),
            F.lit(name).alias("table_name"),
            F.coalesce(F.sum("w"), F.lit(0)).alias("active_bytes"),
            F.lit(0).cast("bigint").alias("time_travel_bytes"),
            F.lit(0).cast("bigint").alias("failsafe_bytes"),
            F.count("*").alias("row_count"),
            altered.alias("last_altered"),
            F.lit(None).cast("date").alias("deleted"),
        ))
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    return union


def table_sizes(stats: DataFrame, *, catalog: str | None = None) -> DataFrame:
    """Storage of live tables; of one catalog if named."""
    if catalog is not None:
        stats = stats.where(F.col("table_catalog") == catalog)
    return (
        stats.where(F.col("deleted").isNull())
        .select(
            "table_schema", "table_name", "active_bytes", "time_travel_bytes",
            "failsafe_bytes", "row_count", "last_altered",
        )
        .orderBy("table_schema", "table_name")
    )


def stamp_text(df: DataFrame, *columns: str) -> DataFrame:
    """Timestamps as second-precision text."""
    return df.withColumns({c: F.date_format(c, _STAMP) for c in columns})


# -- run artifacts ---------------------------------------------------------


def run_summary(artifacts: DataFrame) -> DataFrame:
    """Per artifact: models built, tests passed and failed, elapsed seconds.

    Counted inside the row's own array, so nothing is shuffled.
    """

    def counted(prefix: str, status: str | None = None) -> Column:
        def matches(result: Column) -> Column:
            kind = result["unique_id"].startswith(prefix)
            return kind if status is None else kind & (result["status"] == status)

        return F.size(F.filter("results", matches))

    return artifacts.select(
        F.col("metadata.generated_at").alias("generated_at"),
        counted("model.", "success").alias("models_ok"),
        counted("model.").alias("models_total"),
        counted("test.", "pass").alias("tests_passed"),
        counted("test.").alias("tests_total"),
        (counted("test.") - counted("test.", "pass")).alias("tests_failed"),
        "elapsed_time",
    )


def slowest_models(artifacts: DataFrame, limit: int = 5) -> DataFrame:
    return (
        artifacts.select(
            F.col("metadata.generated_at").alias("generated_at"),
            F.explode("results").alias("result"),
        )
        .where(F.col("result.unique_id").startswith("model."))
        .select(
            F.element_at(F.split("result.unique_id", r"\."), -1).alias("model"),
            F.col("result.execution_time").alias("execution_time"),
            "generated_at",
        )
        .orderBy(F.desc("execution_time"), "model", "generated_at")
        .limit(limit)
    )
