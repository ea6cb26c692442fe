"""Actual against plan at the coarsest grain both inputs share."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from planlens.functions import casts, rules
from planlens.schemas import GRAIN

_ACTUALS = [
    "actual_revenue", "actual_quantity", "actual_margin", "order_count", "on_time_count",
    "late_count", "cancelled_count", "orders_with_known_cost",
]


def plan_cells(monthly: DataFrame, forecast: DataFrame) -> DataFrame:
    """FULL OUTER, so unplanned revenue and unfulfilled plan both stay visible.

    Both sides hold one row per cell (``forecast`` has to be unique on its keys,
    or actuals would fan out). A cell without orders has actuals of zero; a cell
    without a plan has a plan of NULL. Further columns of ``monthly`` come along.
    """
    plan = forecast.select(
        "product_id", "region", F.col("forecast_month").alias("revenue_month"),
        "forecast_revenue", "forecast_quantity",
    )
    zero = {c: F.lit(0).cast(monthly.schema[c].dataType) for c in _ACTUALS}
    return monthly.join(plan, GRAIN, "full").select(
        *GRAIN,
        "forecast_revenue",
        "forecast_quantity",
        *[F.coalesce(c, zero[c]).alias(c) for c in _ACTUALS],
        *[c for c in monthly.columns if c not in {*GRAIN, *_ACTUALS}],
    )


def plan_vs_actual(monthly: DataFrame, forecast: DataFrame) -> DataFrame:
    """The published mart: every cell with its variance, coverage and flag, and further columns
    of ``monthly``, if it has any."""
    variance = F.col("actual_revenue") - F.coalesce("forecast_revenue", F.lit(0))
    arrived = F.col("on_time_count") + F.col("late_count")
    return plan_cells(monthly, forecast).select(
        *GRAIN,
        "actual_revenue",
        "actual_quantity",
        "forecast_revenue",
        "forecast_quantity",
        casts.money(variance).alias("revenue_variance"),
        casts.ratio(variance, F.col("forecast_revenue")).alias("revenue_variance_pct"),
        "actual_margin",
        casts.ratio(F.col("orders_with_known_cost"), F.col("order_count")).alias(
            "margin_coverage_pct"
        ),
        "order_count",
        "on_time_count",
        "late_count",
        "cancelled_count",
        casts.ratio(F.col("on_time_count"), arrived).alias("on_time_delivery_rate"),
        rules.variance_flag(
            plan=F.col("forecast_revenue"),
            actual=F.col("actual_revenue"),
            order_count=F.col("order_count"),
        ).alias("variance_flag"),
        *[c for c in monthly.columns if c not in {*GRAIN, *_ACTUALS}],
    )
