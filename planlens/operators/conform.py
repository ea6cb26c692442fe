"""Typed, trimmed versions of the four landed tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from planlens.functions import casts, rules


def _cleaned(raw: DataFrame) -> DataFrame:
    """Business columns only, trimmed, blank as NULL."""
    return raw.select(
        *[casts.clean_text(F.col(c)).alias(c) for c in raw.columns if not c.startswith("_")]
    )


def stage_accounts(raw: DataFrame) -> DataFrame:
    """Customer accounts, the only path from an order to a region. Inactive ones stay."""
    return _cleaned(raw).select(
        "customer_id", "account_id", "account_name", "region", "account_owner", "segment",
        (F.upper("active_flag") == "TRUE").alias("is_active"),
    )


def stage_products(raw: DataFrame) -> DataFrame:
    """Product master, the only source of cost. A bad cost fails the job."""
    return _cleaned(raw).select(
        "product_id", "product_name", "product_family", "lifecycle_status",
        casts.strict_money(F.col("standard_cost")).alias("standard_cost"),
        (F.col("lifecycle_status") == "Active").alias("is_active_product"),
    )


def stage_forecast(raw: DataFrame) -> DataFrame:
    """Revenue plan per product, region and month. A bad value fails the job."""
    return _cleaned(raw).select(
        "forecast_id", "product_id", "region",
        casts.strict_date(F.col("forecast_month")).alias("forecast_month"),
        casts.strict_money(F.col("forecast_revenue")).alias("forecast_revenue"),
        casts.strict_int(F.col("forecast_quantity")).alias("forecast_quantity"),
    )


def plant_part(location: Column, position: int) -> Column:
    """One half of a "City, Country" text; '' when there is no such half."""
    return F.trim(F.split_part(location, F.lit(","), F.lit(position)))


def type_orders(raw: DataFrame, **carried: Column) -> DataFrame:
    """Order lines with types attached; text that does not parse becomes NULL.

    ``carried`` are further columns, computed from the cleaned texts.
    """
    return (
        _cleaned(raw)
        .select(
            "order_id", "customer_id", "product_id",
            *[casts.lenient_date(F.col(c)).alias(c) for c in
              ("order_date", "promised_delivery_date", "actual_delivery_date")],
            casts.lenient_int(F.col("quantity")).alias("quantity"),
            casts.lenient_money(F.col("unit_price")).alias("unit_price"),
            plant_part(F.col("plant_location"), 1).alias("plant_city"),
            plant_part(F.col("plant_location"), 2).alias("plant_country"),
            "order_status",
            rules.source_batch(order_id=F.col("order_id")).alias("source_batch"),
            *[column.alias(name) for name, column in carried.items()],
        )
        .withColumn("gross_revenue", casts.money(F.col("quantity") * F.col("unit_price")))
    )
