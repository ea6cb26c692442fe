"""Conformed dimensions, with a synthetic member for every key orders mention
but the source does not know."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from planlens.functions import rules
from planlens.schemas import REGION_SEED_SCHEMA

# The region reference list.
REGION_SEED = [
    ("LATAM", "true"),
    ("North America", "true"),
    ("EMEA", "true"),
    ("APAC", "true"),
    ("UNMAPPED", "false"),
]


def region_seed(
    spark: SparkSession, regions: list[tuple[str, str]] = REGION_SEED
) -> DataFrame:
    return spark.createDataFrame(regions, REGION_SEED_SCHEMA)


def dim_region(seed: DataFrame) -> DataFrame:
    """UNMAPPED is a member, flagged as one no plan can ever match."""
    return seed.select("region_name", F.col("is_forecastable").cast("boolean").alias("is_forecastable"))


def _orphans(orders: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Distinct keys used by orders and absent from ``known``: made distinct
    first, so the anti join sees each key once however hot it is."""
    return orders.select(key).distinct().join(known.select(key), key, "left_anti")


def _unknown_name(kind: str, key: str):
    return F.concat(F.lit(f"Unknown {kind} ("), F.col(key), F.lit(")"))


def dim_customer(accounts: DataFrame, orders: DataFrame) -> DataFrame:
    known = accounts.select(
        "customer_id", "account_id", "account_name", "region", "segment", "account_owner",
        "is_active", F.lit(False).alias("is_synthetic"),
    )
    synthetic = _orphans(orders, accounts, "customer_id").select(
        "customer_id",
        F.lit(None).cast("string").alias("account_id"),
        _unknown_name("Customer", "customer_id").alias("account_name"),
        F.lit(rules.UNMAPPED).alias("region"),
        F.lit(rules.UNKNOWN).alias("segment"),
        F.lit(None).cast("string").alias("account_owner"),
        F.lit(False).alias("is_active"),
        F.lit(True).alias("is_synthetic"),
    )
    return known.unionByName(synthetic)


def dim_product(products: DataFrame, orders: DataFrame) -> DataFrame:
    """A synthetic product's cost stays NULL, so its margin stays unknown."""
    known = products.select(
        "product_id", "product_name", "product_family", "lifecycle_status", "standard_cost",
        "is_active_product", F.lit(False).alias("is_synthetic"),
    )
    synthetic = _orphans(orders, products, "product_id").select(
        "product_id",
        _unknown_name("Product", "product_id").alias("product_name"),
        F.lit(rules.UNKNOWN).alias("product_family"),
        F.lit(rules.UNKNOWN).alias("lifecycle_status"),
        F.lit(None).cast("decimal(18,2)").alias("standard_cost"),
        F.lit(False).alias("is_active_product"),
        F.lit(True).alias("is_synthetic"),
    )
    return known.unionByName(synthetic)


# The default calendar, end exclusive.
SPINE_START, SPINE_END = "2025-01-01", "2026-01-01"


def calendar_bounds(spark: SparkSession, start: str = SPINE_START, end: str = SPINE_END) -> DataFrame:
    return spark.range(1).select(
        F.lit(start).cast("date").alias("start"), F.lit(end).cast("date").alias("end")
    )


def dim_date(bounds: DataFrame) -> DataFrame:
    """One row per month from ``start`` up to, not including, ``end``."""
    month = F.explode(F.sequence("start", F.date_sub("end", 1), F.expr("interval 1 month")))
    year, number = F.year("date_month"), F.month("date_month")
    return bounds.select(month.alias("date_month")).select(
        "date_month",
        year.alias("year_number"),
        number.alias("month_number"),
        F.quarter("date_month").alias("quarter_number"),
        F.concat(year.cast("string"), F.lit("-"), F.lpad(number.cast("string"), 2, "0")).alias(
            "year_month_label"
        ),
    )
