"""The rules, row by row, on the hand-written extracts."""

from datetime import date
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from fixtures import ORDERS, REASONS
from planlens.functions import rules
from planlens.operators import checks, mart, measures, monthly, quality
from planlens.plans.pipeline import Pipeline


def by(df, key):
    return {r[key]: r for r in df.collect()}


def cells(df):
    return {(r.product_id, r.region, r.revenue_month): r for r in df.collect()}


def test_every_line_is_kept_or_rejected_with_its_reason(sample):
    for row in sample.flagged.collect():
        assert row.dq_failure_reason == REASONS.get(row.order_id), row
    assert sample.orders.count() + sample.rejects.count() == len(ORDERS)
    assert sample.rejects.where("order_id = 'D2'").count() == 3


def test_types_and_split(sample):
    rows = by(sample.orders, "order_id")
    assert rows["B2"].quantity == 31 and rows["B2"].actual_delivery_date == date(2025, 3, 8)
    assert rows["B2"].promised_delivery_date == date(2025, 3, 9)
    assert (rows["B2"].plant_city, rows["B2"].plant_country) == ("Oslo", "Norway")
    assert (rows["A4"].plant_city, rows["A4"].plant_country) == ("Lyon", "")
    assert rows["B3"].quantity == 100 and rows["B3"].unit_price == D("1.01")
    assert rows["B3"].gross_revenue == D("101.00")
    assert rows["ORD9-1"].source_batch == "BATCH_B" and rows["A1"].source_batch == "BATCH_A"


def test_reject_summary(sample):
    rows = by(sample.reject_summary, "dq_failure_reason")
    assert {k: r.rejected_row_count for k, r in rows.items()} == {
        "AMBIGUOUS_DUPLICATE": 7, "MISSING_ORDER_DATE": 3, "MISSING_UNIT_PRICE": 1,
        "INVALID_QUANTITY": 3,
    }
    assert rows["MISSING_UNIT_PRICE"].rejected_revenue is None
    assert rows["INVALID_QUANTITY"].rejected_revenue == D("-75.00")
    assert rows["AMBIGUOUS_DUPLICATE"].pct_of_source_rows == D("0.2333")
    shown = quality.reject_value_by_reason(sample.reject_summary)
    assert "MISSING_UNIT_PRICE" not in by(shown, "dq_failure_reason")


def test_delivery_status(sample):
    status = {k: r.delivery_status for k, r in by(sample.enriched, "order_id").items()}
    assert status["A1"] == status["A2"] == "On Time"
    assert status["A3"] == status["A4"] == "Late"
    assert status["A5"] == "Unknown"
    assert status["A6"] == "Cancelled"
    assert status["A7"] == "Not Delivered"


def test_delivery_status_takes_no_positional_arguments():
    with pytest.raises(TypeError):
        rules.delivery_status(F.lit(1), F.lit(1), F.lit(1), F.lit(1))


def test_a_failed_lookup_costs_one_attribute(sample):
    rows = by(sample.enriched, "order_id")
    assert len(rows) == sample.orders.count()
    assert rows["ORD9-1"].region == "UNMAPPED" and rows["ORD9-1"].gross_margin == D("18.00")
    assert not rows["ORD9-2"].has_standard_cost and rows["ORD9-2"].gross_margin is None
    assert rows["ORD9-2"].gross_revenue == D("60.00")
    # the product is known, its cost is not
    assert rows["A8"].has_standard_cost and rows["A8"].gross_margin is None
    # the account is known, its region is not
    assert rows["A9"].region == "UNMAPPED" and rows["A9"].account_name == "Lost Clinic"
    assert rows["A5"].gross_margin == D("-10.00")


def test_monthly_rollup_and_its_sql_twin(sample):
    rolled, twin = sample.monthly, monthly.monthly_revenue_sql(sample.enriched)
    assert rolled.schema.simpleString() == twin.schema.simpleString()
    assert rolled.exceptAll(twin).count() == 0 and twin.exceptAll(rolled).count() == 0
    cell = cells(rolled)[("P2", "EMEA", date(2025, 2, 1))]
    assert (cell.actual_revenue, cell.order_count, cell.cancelled_count) == (D("0.00"), 2, 1)
    unknown = cells(rolled)[("P9", "EMEA", date(2025, 1, 1))]
    assert (unknown.actual_margin, unknown.orders_with_known_cost) == (D("0.00"), 0)
    total = sum(r.actual_revenue for r in rolled.collect())
    assert total < sum(r.gross_revenue for r in sample.enriched.collect())
    assert sum(r.cancelled_count for r in rolled.collect()) == 3


def test_mart_flags_and_ratios(sample):
    rows = cells(sample.mart)
    jan, apr = date(2025, 1, 1), date(2025, 4, 1)
    above = rows[("P1", "EMEA", jan)]
    assert (above.variance_flag, above.revenue_variance) == ("AT_OR_ABOVE_PLAN", D("5.00"))
    assert above.revenue_variance_pct == D("0.0833") and above.margin_coverage_pct == D("1.0000")
    assert rows[("P1", "APAC", jan)].variance_flag == "BELOW_PLAN"
    quiet = rows[("P1", "LATAM", jan)]
    assert quiet.variance_flag == "NO_ACTUALS"
    assert (quiet.actual_revenue, quiet.order_count, quiet.actual_quantity) == (D("0.00"), 0, 0)
    assert quiet.margin_coverage_pct is None and quiet.on_time_delivery_rate is None
    unplanned = rows[("P1", "UNMAPPED", jan)]
    assert (unplanned.variance_flag, unplanned.forecast_revenue) == ("NO_FORECAST", None)
    assert unplanned.revenue_variance == D("30.00") and unplanned.revenue_variance_pct is None
    # all cancelled is below plan, not without actuals
    assert rows[("P1", "APAC", apr)].variance_flag == "BELOW_PLAN"
    # nothing recognised against a plan of nothing
    for cell in (("P2", "EMEA", date(2025, 2, 1)), ("P2", "APAC", apr)):
        assert rows[cell].variance_flag == "AT_OR_ABOVE_PLAN"
        assert rows[cell].revenue_variance_pct is None
    assert rows[("P2", "LATAM", date(2025, 5, 1))].variance_flag == "NO_ACTUALS"


def test_dimensions(sample):
    customers = by(sample.dim_customer, "customer_id")
    assert set(customers) == {"C1", "C2", "C3", "C9"}
    assert customers["C9"].is_synthetic and customers["C9"].region == "UNMAPPED"
    assert customers["C9"].account_name == "Unknown Customer (C9)"
    assert not customers["C3"].is_synthetic and not customers["C3"].is_active
    assert customers["C2"].is_active
    products = by(sample.dim_product, "product_id")
    assert products["P9"].is_synthetic and products["P9"].standard_cost is None
    assert products["P9"].product_family == "Unknown" and not products["P3"].is_synthetic
    months = [r.date_month for r in sample.dim_date.orderBy("date_month").collect()]
    assert months[0] == date(2025, 1, 1) and months[-1] == date(2025, 12, 1) and len(months) == 12
    labels = by(sample.dim_date, "year_month_label")
    assert labels["2025-04"].quarter_number == 2
    assert by(sample.dim_region, "region_name")["UNMAPPED"].is_forecastable is False


def test_reconciliation(sample):
    source = measures.source_lines(sample.raw_orders)
    amounts = measures.reconciliation_amounts(
        source, sample.mart, sample.fct_orders, sample.rejects
    )
    row = measures.reconciliation(amounts).first()
    assert row.unexplained == 0 and row.source == row.accounted
    assert (row.open, row.cancelled, row.other) == (D("100.00"), D("200.00"), D("11.00"))
    assert row.rejected == sum(
        (r.gross_revenue or 0) for r in sample.rejects.collect()
    )


def test_what_a_cast_rounds_or_loses_does_not_reconcile(spark, sample):
    for quantity, lost in (("3000000000", D("15000000000.00")), ("31.7", D("-1.50")), ("31.0", D("0"))):
        raw = sample.raw_orders.withColumn("quantity", F.when(
            F.col("order_id") == "A1", quantity).otherwise(F.col("quantity")))
        broken = Pipeline(
            raw_orders=raw, raw_accounts=sample.raw_accounts, raw_products=sample.raw_products,
            raw_forecast=sample.raw_forecast, regions=sample.regions, calendar=sample.calendar,
        )
        row = measures.reconciliation(measures.reconciliation_amounts(
            measures.source_lines(raw), broken.mart, broken.fct_orders, broken.rejects
        )).first()
        assert row.unexplained == lost


def test_rows_lost_by_enrichment_are_counted(sample):
    assert checks.dropped(sample.orders, sample.enriched).count() == 0
    mapped = sample.enriched.where("region <> 'UNMAPPED'")
    twice = sample.enriched.unionByName(sample.enriched)
    assert checks.dropped(sample.orders, mapped).first().n == 2
    assert checks.dropped(sample.orders, twice).first().n == sample.orders.count()
    fanned = sample.mart.unionByName(sample.mart)
    assert checks.lost_by_outer_join(sample.fct_forecast, sample.monthly, fanned).count() == 2


def test_repeated_plan_key_is_caught_before_and_after_the_join(sample):
    twice = sample.forecast.unionByName(
        sample.forecast.where("forecast_id = 'F-1'").withColumn("forecast_id", F.lit("F-1b"))
    )
    grain = ("product_id", "region", "forecast_month")
    assert checks.not_unique(twice, *grain).count() == 1
    fanned = mart.plan_vs_actual(sample.monthly, twice)
    amounts = measures.reconciliation_amounts(
        measures.source_lines(sample.raw_orders), fanned, sample.fct_orders, sample.rejects
    )
    assert checks.unreconciled(measures.reconciliation(amounts)).count() == 1


# -- mutations: each must change what the tests above pin ----------------------


def flags(df):
    return {k: r.variance_flag for k, r in cells(df).items()}


def test_inner_join_would_lose_cells(sample):
    inner = sample.mart.where("forecast_revenue is not null and order_count > 0")
    lost = checks.lost_by_outer_join(sample.fct_forecast, sample.monthly, inner)
    assert {r.lost: r.n for r in lost.collect()} == {"plan rows": 2, "unmapped cells": 2}
    kept = checks.lost_by_outer_join(sample.fct_forecast, sample.monthly, sample.mart)
    assert kept.count() == 0


def test_zero_cost_would_make_up_margin(sample):
    made_up = sample.enriched.withColumn("gross_margin", F.coalesce("gross_margin", "gross_revenue"))
    assert checks.margin_without_cost(made_up).count() == 2
    assert checks.margin_without_cost(sample.enriched).count() == 0


def test_swapped_flag_arms_would_show(sample):
    swapped = sample.mart.withColumn(
        "variance_flag",
        F.when(F.col("order_count") == 0, "NO_ACTUALS")
        .when(F.col("actual_revenue") >= F.col("forecast_revenue"), "AT_OR_ABOVE_PLAN")
        .when(F.col("forecast_revenue").isNull(), "NO_FORECAST")
        .otherwise("BELOW_PLAN"),
    )
    late_plan = sample.mart.withColumn(
        "variance_flag",
        F.when(F.col("forecast_revenue").isNull(), "NO_FORECAST")
        .when(F.col("actual_revenue") >= F.col("forecast_revenue"), "AT_OR_ABOVE_PLAN")
        .when(F.col("order_count") == 0, "NO_ACTUALS")
        .otherwise("BELOW_PLAN"),
    )
    assert flags(late_plan) != flags(sample.mart)
    assert flags(swapped) == flags(sample.mart)  # NULL comparisons keep these arms apart


def test_swapped_defect_arms_would_show(sample):
    def reasons(df):
        return sorted(map(repr, df.select("order_id", "dq_failure_reason").collect()))

    gaps_first = sample.flagged.withColumn("dq_failure_reason", F.when(
        F.col("order_date").isNull(), "MISSING_ORDER_DATE"
    ).otherwise(F.col("dq_failure_reason")))
    assert reasons(gaps_first) != reasons(sample.flagged)


def test_checks_find_broken_rows(sample):
    enriched = sample.enriched
    backdated = enriched.withColumn("delivery_status", F.lit("On Time"))
    assert checks.backdated_misjudged(backdated).count() == 2
    assert checks.backdated_misjudged(enriched).count() == 0
    assert checks.backdated_count(enriched, expected=2).count() == 0
    assert checks.backdated_count(enriched, expected=1).count() == 1
    assert checks.cancelled_but_delivered(backdated).count() == 3
    assert checks.cancelled_but_delivered(enriched).count() == 0
    assert checks.wrongly_unmapped(enriched, sample.accounts).count() == 0
    none_known = sample.accounts.where("false")
    wrong = checks.wrongly_unmapped(enriched, none_known)
    assert {r.customer_id for r in wrong.collect()} == {"C1", "C2"}
    assert checks.duplicates_not_quarantined(sample.typed, sample.orders, sample.rejects).count() == 0
    one_lost = sample.rejects.where("not (order_id = 'D1' and quantity = 99)")
    assert checks.duplicates_not_quarantined(sample.typed, sample.orders, one_lost).count() == 1
    orphans = checks.without_parent(sample.orders, "customer_id", sample.accounts, "customer_id")
    assert {(r.key, r.n) for r in orphans.collect()} == {("C9", 1)}
    lost = checks.partition_complete(sample.raw_orders, sample.orders, one_lost).first()
    assert lost.missing_rows == 1


def test_warnings_do_not_fail(spark):
    results = spark.createDataFrame([("a", 0), ("b", 2), ("c", 3)], "check_name string, failing_rows long")
    verdict = by(checks.verdicts(results, warn_only=["b"]), "check_name")
    assert [verdict[k].status for k in "abc"] == ["pass", "warn", "fail"]
