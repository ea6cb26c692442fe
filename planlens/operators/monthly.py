"""Recognised revenue at the plan's grain: product, region, month.

Written twice, with the DataFrame API and as SQL, so that each can be held
against the other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from planlens.functions import casts
from planlens.schemas import GRAIN


def _sum_where(condition: Column, value: Column) -> Column:
    return F.coalesce(F.sum(F.when(condition, value)), F.lit(0))


def monthly_revenue(enriched: DataFrame, **also: Column) -> DataFrame:
    """Only shipped orders count as revenue; every order is counted.

    Unknown margins add nothing, and ``orders_with_known_cost`` tells how much
    of the total rests on a known cost. ``also`` are further aggregates of a cell.
    """
    recognised = F.col("is_recognised_revenue")
    return enriched.groupBy(*GRAIN).agg(
        casts.money(_sum_where(recognised, F.col("gross_revenue"))).alias("actual_revenue"),
        _sum_where(recognised, F.col("quantity")).alias("actual_quantity"),
        casts.money(_sum_where(recognised, F.col("gross_margin"))).alias("actual_margin"),
        F.count("*").alias("order_count"),
        F.count_if(F.col("delivery_status") == "On Time").alias("on_time_count"),
        F.count_if(F.col("delivery_status") == "Late").alias("late_count"),
        F.count_if(F.col("order_status") == "Cancelled").alias("cancelled_count"),
        F.count_if("has_standard_cost").alias("orders_with_known_cost"),
        *[total.alias(name) for name, total in also.items()],
    )


def monthly_revenue_sql(enriched: DataFrame) -> DataFrame:
    """The same rollup as a SQL statement."""
    return enriched.sparkSession.sql(
        """
        SELECT product_id, region, revenue_month,
               CAST(coalesce(sum(gross_revenue) FILTER (WHERE is_recognised_revenue), 0)
                    AS DECIMAL(18,2)) AS actual_revenue,
               coalesce(sum(quantity) FILTER (WHERE is_recognised_revenue), 0) AS actual_quantity,
               CAST(coalesce(sum(gross_margin) FILTER (WHERE is_recognised_revenue), 0)
                    AS DECIMAL(18,2)) AS actual_margin,
               count(*) AS order_count,
               count(*) FILTER (WHERE delivery_status = 'On Time') AS on_time_count,
               count(*) FILTER (WHERE delivery_status = 'Late') AS late_count,
               count(*) FILTER (WHERE order_status = 'Cancelled') AS cancelled_count,
               count(*) FILTER (WHERE has_standard_cost) AS orders_with_known_cost
        FROM {enriched}
        GROUP BY product_id, region, revenue_month
        """,
        enriched=enriched,
    )
