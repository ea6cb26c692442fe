"""Name every defect, keep every row: clean rows go on, the rest are quarantined."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from planlens.functions import casts, rules
from planlens.operators import joins, keyfilter

ORDER_COLUMNS = [
    "order_id", "customer_id", "product_id", "order_date", "promised_delivery_date",
    "actual_delivery_date", "quantity", "unit_price", "gross_revenue", "plant_city",
    "plant_country", "order_status", "source_batch",
]

# Rows without an id are duplicates of each other. Trimmed text is never a lone
# space, so it can stand for "no id" as a join key.
_NO_ID = " "

_ROW_BYTES = 64  # of a repeated id and its count, in a table of a join


def _id_key():
    return F.coalesce(F.col("order_id"), F.lit(_NO_ID)).alias("_id_key")


def duplicate_ids(orders: DataFrame) -> DataFrame:
    """Ids on more than one line, with their line count.

    Only the id column is read and counts are combined before the shuffle, so a
    single id on a third of all lines is one row per task.
    """
    return (
        orders.select(_id_key())
        .groupBy("_id_key")
        .agg(F.count("*").alias("n"))
        .where(F.col("n") > 1)
    )


def filter_bits(duplicates: DataFrame, count: int | None = None) -> int | None:
    """The size of the filter for stored ``duplicates``, ``count`` rows if that is known; None if
    they may be broadcast, as the session measures it."""
    spark = duplicates.sparkSession
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold").lower().removesuffix("b")
    count = duplicates.count() if count is None else count  # from the footers of its files
    most = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(limit) if limit != "-1" else -1
    return None if count * _ROW_BYTES <= most else keyfilter.bits_for(count)


def flag_orders(
    orders: DataFrame, duplicates: DataFrame, *, filter_bits: int | None = None
) -> DataFrame:
    """Attach ``dq_failure_reason`` (NULL = clean) to every line.

    The same verdict as counting lines over a window per id, but a hot id does not
    gather its lines in one task. Columns that ``orders`` carries besides its own stay.

    With ``filter_bits`` a Bloom filter of the repeated ids splits the lines first: those
    that it clears are named where they lie, and only the rest is joined, for lists of ids
    too long to broadcast. That takes two reads of the lines instead of a shuffle of all.
    """
    carried = [c for c in orders.columns if c not in ORDER_COLUMNS]
    keyed = orders.withColumn("_id_key", _id_key())
    if filter_bits is None:
        matched = joins.lookup(keyed, duplicates, "_id_key")
    else:
        listed = keyfilter.key_filter(duplicates, "_id_key", filter_bits)
        split = keyfilter.maybe_listed(keyed, F.col("_id_key"), listed, filter_bits, "_maybe")
        apart = split.where(~F.col("_maybe")).drop("_maybe").withColumn("n", F.lit(None).cast("bigint"))
        suspects = split.where("_maybe").drop("_maybe")
        matched = apart.unionByName(joins.lookup(suspects, duplicates, "_id_key"))
    reason = rules.defect_reason(
        is_duplicate=F.col("n").isNotNull(),
        order_date=F.col("order_date"),
        unit_price=F.col("unit_price"),
        quantity=F.col("quantity"),
    )
    return matched.select(*ORDER_COLUMNS, *carried, reason.alias("dq_failure_reason"))


def clean_orders(flagged: DataFrame) -> DataFrame:
    return flagged.where(F.col("dq_failure_reason").isNull()).select(*ORDER_COLUMNS)


def rejected_orders(flagged: DataFrame) -> DataFrame:
    return flagged.where(F.col("dq_failure_reason").isNotNull())


def rejects_listing(rejects: DataFrame) -> DataFrame:
    """Rejects by reason and id. The row number only spreads equal keys, so that
    the copies of one id are sorted by many tasks."""
    return rejects.orderBy("dq_failure_reason", "order_id", F.monotonically_increasing_id())


def reject_summary(flagged: DataFrame) -> DataFrame:
    """Rows, value and share of all source lines per reason.

    One pass: the aggregate yields a row per reason and one for clean lines, at
    most five, and the share is taken over those. A reason's total is wider than the
    published amounts, as it may be of any number of lines.
    """
    per_reason = flagged.groupBy("dq_failure_reason").agg(
        F.count("*").alias("rejected_row_count"),
        F.sum("gross_revenue").cast("decimal(28,2)").alias("rejected_revenue"),
    )
    source_rows = F.sum("rejected_row_count").over(Window.partitionBy())
    return per_reason.select(
        "dq_failure_reason",
        "rejected_row_count",
        "rejected_revenue",
        casts.ratio(F.col("rejected_row_count"), source_rows).alias("pct_of_source_rows"),
    ).where(F.col("dq_failure_reason").isNotNull())


def reject_value_by_reason(summary: DataFrame) -> DataFrame:
    """Reasons whose excluded value is known."""
    return summary.where(F.col("rejected_revenue").isNotNull()).select(
        "dq_failure_reason", "rejected_revenue"
    )
