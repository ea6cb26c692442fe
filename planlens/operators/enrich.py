"""Attach what an order needs but does not carry: region and standard cost."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from planlens.functions import casts, rules
from planlens.operators import joins
from planlens.operators.quality import ORDER_COLUMNS


def enrich_orders(
    orders: DataFrame,
    accounts: DataFrame,
    products: DataFrame,
    *,
    recognised_on: str = "order_date",
) -> DataFrame:
    """Both lookups are LEFT: a miss costs one attribute, never the revenue."""
    account_columns = accounts.select(
        "customer_id", "region", "segment", "account_name",
        F.col("is_active").alias("is_active_account"),
    )
    product_columns = products.select(
        "product_id", "product_family", "lifecycle_status", "standard_cost",
        F.lit(True).alias("_product_found"),
    )
    joined = joins.lookups(
        orders,
        {"customer_id": account_columns, "product_id": product_columns},
    )
    unit_margin = F.col("unit_price") - F.col("standard_cost")
    return joined.select(
        *ORDER_COLUMNS,
        F.coalesce("region", F.lit(rules.UNMAPPED)).alias("region"),
        "segment",
        "account_name",
        "is_active_account",
        "product_family",
        "lifecycle_status",
        "standard_cost",
        F.col("_product_found").isNotNull().alias("has_standard_cost"),
        # Unknown cost leaves the margin unknown; zero would claim all of it.
        casts.money(unit_margin * F.col("quantity")).alias("gross_margin"),
        rules.delivery_status(
            order_status=F.col("order_status"),
            order_date=F.col("order_date"),
            promised_date=F.col("promised_delivery_date"),
            actual_date=F.col("actual_delivery_date"),
        ).alias("delivery_status"),
        F.trunc(recognised_on, "month").alias("revenue_month"),
        (F.col("order_status") == "Shipped").alias("is_recognised_revenue"),
    )


# The published fact columns.
FCT_ORDERS = [
    "order_id", "customer_id", "product_id", "region", "revenue_month", "order_date",
    "promised_delivery_date", "actual_delivery_date", "quantity", "unit_price",
    "gross_revenue", "gross_margin", "has_standard_cost", "order_status",
    "delivery_status", "is_recognised_revenue", "plant_city", "plant_country",
    "source_batch",
]
FCT_FORECAST = [
    "forecast_id", "product_id", "region", "forecast_month", "forecast_revenue",
    "forecast_quantity",
]


def fct_orders(enriched: DataFrame) -> DataFrame:
    return enriched.select(*FCT_ORDERS)


def fct_forecast(forecast: DataFrame) -> DataFrame:
    return forecast.select(*FCT_FORECAST)
