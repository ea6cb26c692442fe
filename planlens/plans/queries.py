"""The registered queries: one callable per operator, over the test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from planlens.functions import casts, rules
from planlens.operators import checks, measures, monthly, observe, quality
from planlens.schemas import SOURCE_TABLES
from planlens.session import settle
from planlens.sources import landing
from planlens.sources.run_artifacts import parse_run_artifacts
from planlens.sources.testdata import AS_OF, BATCH_ID, REGIONS, SampleModel

Query = Callable[[SparkSession, str], DataFrame]

FILTER = {
    "regions": ["ASIA", "EUROPE", rules.UNMAPPED],
    "families": ["ECONOMY", rules.UNKNOWN],
    "months": ("1996-01-01", "2000-12-01"),
}
# Within the events, so that the windows leave rows out at both ends.
JOBS_AS_OF = "2024-01-20 00:00:00"

DOMAINS = {
    "regions": REGIONS,
    "segments": ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"),
    "lifecycles": checks.DOMAINS["lifecycles"],
    "plant_countries": REGIONS,
}


def _of(
    build: Callable[[SampleModel], DataFrame], settled: bool | tuple[str, ...] = False
) -> Query:
    return lambda spark, sf_dir: build(SampleModel(spark, sf_dir, settled))


# -- sources -----------------------------------------------------------------


def _landed(m: SampleModel) -> DataFrame:
    stamped = landing.stamp_metadata(
        m.raw_orders,
        loaded_at=F.lit(AS_OF).cast("timestamp"),
        source_file=F.lit("oracle_orders.csv"),
        batch_id=F.lit(BATCH_ID),
    )
    return observe.stamp_text(stamped, "_loaded_at")


def _landed_csv(m: SampleModel) -> DataFrame:
    return observe.stamp_text(m.landed_extract("oracle_orders.csv"), "_loaded_at")


def _landed_csv_counts(m: SampleModel) -> DataFrame:
    m.extract_folder(*SOURCE_TABLES)
    return landing.landed_row_counts(
        {table: m.landed_extract(name) for name, table in SOURCE_TABLES.items()}
    )


def _layers(m: SampleModel) -> DataFrame:
    tables = {("raw", name): df for name, df in m.raw_tables.items()}
    tables.update({
        ("staging", "stg_accounts"): m.accounts,
        ("staging", "stg_products"): m.products,
        ("staging", "stg_forecast"): m.forecast,
        ("staging", "stg_orders"): m.orders,
        ("staging", "stg_rejects"): m.rejects,
        ("staging", "stg_orders_flagged"): m.flagged,
        ("staging", "int_orders_enriched"): m.enriched,
        ("staging", "int_order_revenue_monthly"): m.monthly,
        ("staging", "seed_region"): m.regions,
        ("analytics", "dim_customer"): m.dim_customer,
        ("analytics", "dim_product"): m.dim_product,
        ("analytics", "dim_region"): m.dim_region,
        ("analytics", "dim_date"): m.dim_date,
        ("analytics", "fct_orders"): m.fct_orders,
        ("analytics", "fct_forecast"): m.fct_forecast,
        ("analytics", "mart"): m.mart,
        ("analytics", "dq_reject_summary"): m.reject_summary,
    })
    return observe.layer_row_counts(tables)


# -- casts and rules ---------------------------------------------------------


def _lenient_casts(m: SampleModel) -> DataFrame:
    """The cast recipes on texts in many shapes, one shape per line number."""
    shape = F.col("l_linenumber") % 7
    pieces = F.round("l_quantity").cast("bigint").cast("string")
    cents = F.col("l_extendedprice").cast(casts.MONEY).cast("string")
    day = F.col("l_shipdate").cast("date").cast("string")

    def shaped(*options: Column) -> Column:
        picked = F.when(shape == 0, options[0])
        for i, option in enumerate(options[1:], start=1):
            picked = picked.when(shape == i, option)
        return casts.clean_text(picked)

    texts = m.table("lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber",
        shaped(
            pieces, F.concat(pieces, F.lit(".0")), F.concat(pieces, F.lit(".5")),
            F.concat(pieces, F.lit("e1")), F.concat(F.lit("  "), pieces, F.lit(" ")),
            F.concat(F.lit("n/a "), pieces), F.concat(pieces, F.lit("0000000000")),
        ).alias("int_text"),
        shaped(
            cents, F.concat(cents, F.lit("5")), F.concat(cents, F.lit("49")),
            F.concat(F.lit("$"), cents), F.concat(F.lit("-"), cents), F.lit(" "),
            F.concat(cents, F.lit("e2")),
        ).alias("money_text"),
        shaped(
            day, F.substring(day, 1, 4), F.substring(day, 1, 7), F.translate(day, "-", "/"),
            F.concat(day, F.lit(" 10:30:00")), F.concat(F.lit(" "), day),
            F.concat(F.substring(day, 1, 8), F.lit("32")),
        ).alias("date_text"),
    )
    return texts.select(
        "l_orderkey", "l_partkey", "l_linenumber",
        casts.lenient_int(F.col("int_text")).alias("int_value"),
        casts.lenient_money(F.col("money_text")).alias("money_value"),
        casts.lenient_date(F.col("date_text")).alias("date_value"),
    )


def _plant_split(m: SampleModel) -> DataFrame:
    return m.typed.groupBy("plant_city", "plant_country").agg(F.count("*").alias("line_count"))


def _rejects(m: SampleModel) -> DataFrame:
    """Stored before they are sorted: a sort reads its rows twice, once to place its ranges, and
    would type and flag all lines for each."""
    return quality.rejects_listing(settle(m.rejects))


def _source_batch_mix(m: SampleModel) -> DataFrame:
    return m.flagged.groupBy("source_batch").agg(
        F.count("*").alias("line_count"),
        F.count("dq_failure_reason").alias("rejected_count"),
    )


# -- measures ----------------------------------------------------------------


def _filtered_mart(m: SampleModel) -> DataFrame:
    chosen = {k: FILTER[k] for k in ("regions", "months")}
    mart = m.mart_of(lambda rows, month: measures.restrict(rows, month=month, **chosen))
    filtered = measures.apply_filters(mart, m.dim_product, families=FILTER["families"])
    return measures.detail_table(filtered, ["BELOW_PLAN", "AT_OR_ABOVE_PLAN", "NO_FORECAST"])


def _filtered_orders(m: SampleModel) -> DataFrame:
    filtered = measures.apply_filters(m.fct_orders, m.dim_product, **FILTER)
    return filtered.groupBy("region", "product_family", "order_status").agg(
        F.count("*").alias("order_count"), F.sum("gross_revenue").alias("gross_revenue")
    )


def _star_rollup(m: SampleModel) -> DataFrame:
    star = measures.star(m.cells, m.dim_product, m.dim_region, m.dim_date)
    return measures.measures(star, "product_family", "is_forecastable", "year_number")


def _reconciliation(m: SampleModel) -> DataFrame:
    return measures.explained(m.reconciliation_totals())


# -- checks: one row per check, some on deliberately broken input --------------


def _check_unique(m: SampleModel) -> DataFrame:
    twice = m.accounts.unionByName(m.accounts.where(F.col("segment") == "BUILDING"))
    tables = {
        "typed": m.typed, "stg_orders": m.orders, "stg_accounts": m.accounts,
        "accounts_twice": twice, "stg_products": m.products, "stg_forecast": m.forecast,
        "dim_customer": m.dim_customer, "dim_product": m.dim_product, "dim_date": m.dim_date,
        "dim_region": m.dim_region,
    }
    keys = {
        "typed": "order_id", "stg_orders": "order_id", "stg_accounts": "customer_id",
        "accounts_twice": "customer_id", "stg_products": "product_id",
        "stg_forecast": "forecast_id", "dim_customer": "customer_id",
        "dim_product": "product_id", "dim_date": "date_month", "dim_region": "region_name",
    }
    return checks.in_one_pass(
        tables, [checks.Unique(f"{table}.{key}", table, (key,)) for table, key in keys.items()]
    )


def _check_not_null(m: SampleModel) -> DataFrame:
    columns = {
        "typed": ("order_id", "order_date", "unit_price", "quantity", "actual_delivery_date"),
        "orders_enriched": (
            "order_id", "region", "delivery_status", "revenue_month", "gross_revenue", "segment",
            "standard_cost",
        ),
        "mart": (
            "product_id", "region", "revenue_month", "actual_revenue", "revenue_variance",
            "forecast_revenue",
        ),
    }
    return checks.in_one_pass({"typed": m.typed, "orders_enriched": m.enriched, "mart": m.mart}, [
        checks.Rows(f"{table}.{c}", table, checks.is_missing(c))
        for table, names in columns.items() for c in names
    ])


def _check_accepted_values(m: SampleModel) -> DataFrame:
    accepted = [
        ("order_status", "flagged", "order_status", rules.ORDER_STATUSES),
        ("source_batch", "flagged", "source_batch", rules.SOURCE_BATCHES),
        ("dq_failure_reason", "flagged", "dq_failure_reason", rules.DEFECT_REASONS),
        ("plant_country", "flagged", "plant_country", ["ASIA", "EUROPE"]),
        ("region", "enriched", "region", [*REGIONS, rules.UNMAPPED]),
        ("mapped_region", "enriched", "region", REGIONS),
        ("delivery_status", "enriched", "delivery_status", rules.DELIVERY_STATUSES),
        ("variance_flag", "mart", "variance_flag", rules.VARIANCE_FLAGS),
    ]
    results = checks.in_one_pass({"flagged": m.flagged, "enriched": m.enriched, "mart": m.mart}, [
        checks.Rows(name, table, checks.is_unaccepted(column, values))
        for name, table, column, values in accepted
    ])
    return checks.verdicts(results, warn_only=["plant_country"])


def _check_relationships(m: SampleModel) -> DataFrame:
    tables = {
        "orders": m.orders, "accounts": m.accounts, "products": m.products,
        "forecast": m.forecast, "dim_customer": m.dim_customer, "dim_product": m.dim_product,
        "dim_region": m.dim_region, "mart": m.mart,
    }
    parents = [
        ("orders", "customer_id", "accounts", "customer_id"),
        ("orders", "product_id", "products", "product_id"),
        ("orders", "customer_id", "dim_customer", "customer_id"),
        ("orders", "product_id", "dim_product", "product_id"),
        ("forecast", "product_id", "products", "product_id"),
        ("dim_customer", "region", "dim_region", "region_name"),
        ("mart", "region", "dim_region", "region_name"),
    ]
    return checks.in_one_pass(tables, [
        checks.Orphans(f"{child}-{parent}", child, column, parent, key)
        for child, column, parent, key in parents
    ])


def _check_unique_grain(m: SampleModel) -> DataFrame:
    cell = ("product_id", "region", "revenue_month")
    plan = ("product_id", "region", "forecast_month")
    tables = {"mart": m.mart, "fct_forecast": m.fct_forecast, "orders_by_month": m.enriched}
    return checks.in_one_pass(tables, [
        checks.Unique("mart", "mart", cell), checks.Unique("fct_forecast", "fct_forecast", plan),
        checks.Unique("orders_by_month", "orders_by_month", cell),
    ])


def _check_partition_complete(m: SampleModel) -> DataFrame:
    return checks.together([
        checks.counted(
            "complete", checks.partition_complete(m.raw_orders, m.orders, m.rejects)
        ),
        checks.counted(
            "rejects_dropped",
            checks.partition_complete(m.raw_orders, m.orders, m.rejects.where(F.lit(False))),
            F.col("missing_rows"),
        ),
    ])


def _check_reconciles(m: SampleModel) -> DataFrame:
    # Quantities that an integer can't hold are lost by the cast, not by the source.
    huge = F.when(
        F.col("order_status") == "Cancelled", F.concat("quantity", F.lit("0000000000"))
    ).otherwise(F.col("quantity"))
    totals = m.reconciliation_totals(
        recognised={"recognised": F.lit(True), "mapped": F.col("region") != rules.UNMAPPED},
        huge=huge,
    )
    cases = {
        "reconciles": ("source", "recognised"), "unmapped_dropped": ("source", "mapped"),
        "quantity_lost": ("huge", "recognised"),
    }
    each = totals.select(F.inline(F.array(*[
        F.struct(
            F.lit(name).alias("check_name"), F.col(source).alias("source"),
            F.col(recognised).alias("recognised"), "open", "cancelled", "other", "rejected",
        )
        for name, (source, recognised) in cases.items()
    ])))
    return measures.explained(each).select(
        "check_name", checks.is_unreconciled().cast("bigint").alias("failing_rows")
    )


def _check_duplicates(m: SampleModel) -> DataFrame:
    kept = m.orders.unionByName(m.rejects.select(*m.orders.columns))
    return checks.together([
        checks.counted("quarantined", checks.duplicates_not_quarantined(
            m.typed, m.orders, m.rejects
        )),
        checks.counted("kept", checks.duplicates_not_quarantined(m.typed, kept, m.rejects)),
    ])


def _check_margin_null(m: SampleModel) -> DataFrame:
    made_up = m.enriched.withColumn("gross_margin", F.coalesce("gross_margin", "gross_revenue"))
    return checks.together([
        checks.counted("margin_null", checks.margin_without_cost(m.enriched)),
        checks.counted("margin_made_up", checks.margin_without_cost(made_up)),
    ])


def _check_unmapped(m: SampleModel) -> DataFrame:
    fewer = m.accounts.where(F.col("segment") != "BUILDING")
    return checks.together([
        checks.counted("unmapped", checks.wrongly_unmapped(m.enriched, m.accounts), F.col("n")),
        checks.counted("accounts_lost", checks.wrongly_unmapped(m.enriched, fewer), F.col("n")),
        checks.counted("rows_kept", checks.dropped(m.orders, m.enriched), F.col("n")),
        checks.counted("rows_dropped", checks.dropped(
            m.orders, m.enriched.where(F.col("region") != rules.UNMAPPED)
        ), F.col("n")),
    ])


def _check_cancelled(m: SampleModel) -> DataFrame:
    by_date = m.enriched.withColumn("delivery_status", F.when(
        F.col("actual_delivery_date").isNotNull(), "Late"
    ).otherwise(F.col("delivery_status")))
    return checks.together([
        checks.counted("cancelled", checks.cancelled_but_delivered(m.enriched)),
        checks.counted("date_wins", checks.cancelled_but_delivered(by_date)),
    ])


def _check_backdated(m: SampleModel) -> DataFrame:
    ignored = m.enriched.withColumn("delivery_status", F.lit("On Time"))
    return checks.together([
        checks.counted("backdated", checks.backdated_misjudged(m.enriched)),
        checks.counted("rule_ignored", checks.backdated_misjudged(ignored)),
        checks.counted("backdated_rows", checks.backdated_count(m.enriched), F.col("backdated")),
    ])


def _check_outer_join_survival(m: SampleModel) -> DataFrame:
    inner = m.mart.where(F.col("forecast_revenue").isNotNull() & (F.col("order_count") > 0))
    return checks.together([
        checks.counted("full_outer", checks.lost_by_outer_join(
            m.fct_forecast, m.monthly, m.mart
        ), F.col("n")),
        checks.counted("inner", checks.lost_by_outer_join(
            m.fct_forecast, m.monthly, inner
        ), F.col("n")),
    ])


def _check_suite(m: SampleModel) -> DataFrame:
    """Every column check of every layer."""
    tables = {
        "stg_orders": m.orders, "stg_rejects": m.rejects, "stg_accounts": m.accounts,
        "stg_forecast": m.forecast, "stg_products": m.products, "orders_enriched": m.enriched,
        "monthly_revenue": m.monthly, "dim_date": m.dim_date, "dim_region": m.dim_region,
        "dim_customer": m.dim_customer, "dim_product": m.dim_product,
        "fct_orders": m.fct_orders, "fct_forecast": m.fct_forecast, "mart": m.mart,
        "reject_summary": m.reject_summary,
    }
    return checks.run_suite(tables, checks.model_expectations(DOMAINS))


QUERIES: dict[str, Query] = {
    # sources
    "land_raw_orders": _of(_landed),
    "land_csv_orders": _of(_landed_csv),
    "landed_csv_counts": _of(_landed_csv_counts),
    "landed_row_counts": _of(lambda m: landing.landed_row_counts(m.raw_tables)),
    # Counting enriched lines moves a key of each; a stored copy would be all their columns.
    "layer_row_counts": _of(_layers, settled=("flagged",)),
    "run_results_summary": _of(lambda m: observe.run_summary(m.run_artifacts)),
    "slowest_models": _of(lambda m: observe.slowest_models(parse_run_artifacts(m.run_documents))),
    # staging
    "stg_accounts": _of(lambda m: m.accounts),
    "stg_products": _of(lambda m: m.products),
    "stg_forecast": _of(lambda m: m.forecast),
    "lenient_casts": _of(_lenient_casts),
    "plant_split": _of(_plant_split),
    "source_batch_mix": _of(_source_batch_mix),
    "orders_flagged": _of(lambda m: m.flagged),
    "stg_orders": _of(lambda m: m.orders),
    "orders_rejects": _of(_rejects),
    "reject_summary": _of(lambda m: m.reject_summary),
    "reject_value_by_reason": _of(lambda m: quality.reject_value_by_reason(m.reject_summary)),
    # enrichment, rollup, mart
    "orders_enriched": _of(lambda m: m.enriched),
    "delivery_status": _of(
        lambda m: m.enriched.groupBy("delivery_status", "order_status").agg(
            F.count("*").alias("order_count")
        )
    ),
    "monthly_revenue": _of(lambda m: m.monthly),
    "monthly_revenue_sql": _of(lambda m: monthly.monthly_revenue_sql(m.enriched)),
    "plan_vs_actual": _of(lambda m: m.mart),
    # dimensions and facts
    "dim_region": _of(lambda m: m.dim_region),
    "dim_date": _of(lambda m: m.dim_date),
    "dim_customer": _of(lambda m: m.dim_customer),
    "dim_product": _of(lambda m: m.dim_product),
    "fct_orders": _of(lambda m: m.fct_orders),
    "fct_forecast": _of(lambda m: m.fct_forecast),
    # filters and the star
    "filter_options": _of(lambda m: measures.filter_options(m.mart, m.dim_product)),
    "filtered_mart": _of(_filtered_mart),
    "filtered_orders": _of(_filtered_orders),
    "entitled_mart": _of(
        lambda m: m.mart_of(
            lambda rows, _: measures.entitled(rows, m.entitlements, "nation_7@example.com")
        )
    ),
    "star_rollup": _of(_star_rollup),
    "orders_by_segment": _of(
        lambda m: measures.orders_by_customer_attribute(m.fct_orders, m.dim_customer, "segment")
    ),
    # revenue against plan
    "headline_kpis": _of(lambda m: measures.headline_kpis(m.mart)),
    "monthly_trend": _of(lambda m: measures.monthly_trend(m.mart)),
    "variance_by_region": _of(lambda m: measures.variance_by_region(m.mart)),
    "variance_by_flag": _of(lambda m: measures.variance_by_flag(m.mart)),
    "variance_by_family": _of(
        lambda m: measures.variance_by_family(measures.with_family(m.mart, m.dim_product))
    ),
    "worst_variance": _of(lambda m: measures.worst_variance(m.mart)),
    "top_bottom_variance": _of(lambda m: measures.top_bottom_variance(m.mart)),
    "flag_cells": _of(lambda m: measures.flag_cells(m.mart)),
    "flag_pivot": _of(lambda m: measures.flag_pivot(m.mart, [*REGIONS, rules.UNMAPPED])),
    "cell_composition": _of(lambda m: measures.cell_composition(m.mart)),
    "composition_pivot": _of(
        lambda m: measures.composition_pivot(m.mart, [*REGIONS, rules.UNMAPPED])
    ),
    "flag_counts_two_grains": _of(lambda m: measures.flag_counts_two_grains(m.mart)),
    "reconciliation": _of(_reconciliation),
    # delivery
    "delivery_distribution": _of(lambda m: measures.delivery_distribution(m.fct_orders)),
    "on_time_by_region": _of(lambda m: measures.on_time_by_region(m.fct_orders)),
    "delivery_gap": _of(lambda m: measures.delivery_gap(m.fct_orders)),
    "late_orders": _of(lambda m: measures.late_orders(m.fct_orders)),
    "contradiction_counts": _of(lambda m: measures.contradiction_counts(m.fct_orders)),
    "degraded_orders": _of(lambda m: measures.degraded_orders(m.fct_orders)),
    # margin and products
    "margin_coverage": _of(lambda m: measures.margin_coverage(m.fct_orders)),
    "margin_by_product": _of(
        lambda m: measures.margin_by_product(m.mart, m.fct_orders, m.dim_product), settled=True
    ),
    "uncovered_orders": _of(lambda m: measures.uncovered_orders(m.fct_orders)),
    "uncovered_products": _of(lambda m: measures.uncovered_products(m.fct_orders)),
    "lifecycle_counts": _of(lambda m: measures.lifecycle_counts(m.dim_product)),
    "product_list": _of(lambda m: measures.product_list(m.dim_product)),
    # telemetry
    "load_freshness": _of(
        lambda m: observe.stamp_text(observe.load_freshness(m.load_log), "last_loaded_at")
    ),
    "freshness_by_source": _of(lambda m: observe.stamp_text(
        observe.freshness_by_source(m.load_log, AS_OF), "last_loaded_at"
    )),
    "freshness_of_loads": _of(lambda m: observe.stamp_text(
        observe.freshness_by_source(m.commit_log, AS_OF), "last_loaded_at"
    )),
    "freshness_verdict": _of(lambda m: observe.freshness_verdict(m.load_log, AS_OF)),
    "cost_by_day": _of(lambda m: observe.cost_by_day(m.compute_usage, JOBS_AS_OF, days=14)),
    "cost_of_warehouses": _of(lambda m: observe.cost_by_day(
        m.compute_usage, JOBS_AS_OF, days=14, warehouses=["WH_1", "WH_4", "WH_7"]
    )),
    "recent_jobs": _of(lambda m: observe.stamp_text(
        observe.recent_jobs(m.job_history, JOBS_AS_OF, database="SHOP"), "start_time"
    )),
    "failed_jobs": _of(lambda m: observe.stamp_text(
        observe.failed_jobs(m.job_history, JOBS_AS_OF, database="SHOP"), "start_time"
    )),
    "table_sizes": _of(lambda m: observe.table_sizes(m.table_stats, catalog="SHOP")),
    # checks
    "check_suite": _of(_check_suite, settled=True),
    "check_unique": _of(_check_unique, settled=True),
    "check_not_null": _of(_check_not_null, settled=True),
    "check_accepted_values": _of(_check_accepted_values, settled=True),
    # The enriched lines are read by the rollup alone, which is stored.
    "check_relationships": _of(_check_relationships, settled=("flagged",)),
    "check_unique_grain": _of(_check_unique_grain),
    "check_partition_complete": _of(_check_partition_complete),
    "check_reconciles": _of(_check_reconciles),
    "check_duplicates_quarantined": _of(_check_duplicates),
    "check_margin_null": _of(_check_margin_null, settled=True),
    "check_unmapped": _of(_check_unmapped, settled=True),
    "check_cancelled": _of(_check_cancelled, settled=True),
    "check_backdated": _of(_check_backdated, settled=True),
    "check_outer_join_survival": _of(_check_outer_join_survival, settled=True),
}
