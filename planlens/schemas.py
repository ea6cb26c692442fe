"""Column contracts of the landed tables. Landed text is never coerced."""

from __future__ import annotations

from pyspark.sql import types as T


def _text(*names: str) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


# Extract file -> landed table, and each extract's header.
SOURCE_TABLES = {
    "oracle_orders.csv": "raw_oracle_orders",
    "salesforce_accounts.csv": "raw_salesforce_accounts",
    "adaptive_forecast.csv": "raw_adaptive_forecast",
    "product_master.csv": "raw_erp_products",
}

RAW_SCHEMAS = {
    "raw_oracle_orders": _text(
        "order_id", "customer_id", "product_id", "order_date", "promised_delivery_date",
        "actual_delivery_date", "quantity", "unit_price", "plant_location", "order_status",
    ),
    "raw_salesforce_accounts": _text(
        "account_id", "customer_id", "account_name", "region", "account_owner", "segment",
        "active_flag",
    ),
    "raw_adaptive_forecast": _text(
        "forecast_id", "product_id", "region", "forecast_month", "forecast_revenue",
        "forecast_quantity",
    ),
    "raw_erp_products": _text(
        "product_id", "product_name", "product_family", "lifecycle_status", "standard_cost",
    ),
}

# The metadata of a landed row, and the grain of the mart.
METADATA_COLUMNS = ("_loaded_at", "_source_file", "_batch_id")

GRAIN = ["product_id", "region", "revenue_month"]

REGION_SEED_SCHEMA = _text("region_name", "is_forecastable")

RUN_ARTIFACT_SCHEMA = T.StructType([
    T.StructField("metadata", T.StructType([T.StructField("generated_at", T.StringType())])),
    T.StructField("elapsed_time", T.DoubleType()),
    T.StructField("results", T.ArrayType(T.StructType([
        T.StructField("unique_id", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("execution_time", T.DoubleType()),
    ]))),
])
