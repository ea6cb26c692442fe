"""Dashboard aggregates on the hand-written extracts."""

from datetime import date
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from planlens.operators import measures
from planlens.plans.queries import QUERIES


def by(df, key):
    return {r[key]: r for r in df.collect()}


def test_empty_filters_keep_everything(sample):
    mart, products = sample.mart, sample.dim_product
    everything = measures.apply_filters(mart, products)
    assert everything.count() == mart.count()
    assert everything.where("product_family is null").count() == 0
    assert measures.detail_table(everything).count() == mart.count()


def test_filters_compose(sample):
    mart, products = sample.mart, sample.dim_product
    toys = measures.apply_filters(mart, products, families=["Toys"])
    assert {r.product_id for r in toys.collect()} == {"P2", "P3"}
    unknown = measures.apply_filters(mart, products, families=["Unknown"])
    assert {r.product_id for r in unknown.collect()} == {"P9"}
    months = measures.apply_filters(
        mart, products, regions=["EMEA"], months=("2025-02-01", "2025-03-01")
    )
    assert {r.revenue_month for r in months.collect()} == {date(2025, 2, 1), date(2025, 3, 1)}
    assert {r.region for r in months.collect()} == {"EMEA"}
    flagged = measures.detail_table(
        measures.apply_filters(mart, products), ["NO_ACTUALS"]
    )
    assert {r.variance_flag for r in flagged.collect()} == {"NO_ACTUALS"}


def test_unknown_family_when_the_dimension_lacks_the_product(sample):
    fewer = sample.dim_product.where("product_id <> 'P9'")
    rows = by(measures.with_family(sample.mart, fewer), "product_id")
    assert rows["P9"].product_family == "Unknown"


def test_filter_options(sample):
    options = measures.filter_options(sample.mart, sample.dim_product).collect()
    assert [r.option for r in options if r.filter == "product_family"] == ["Tools", "Toys", "Unknown"]
    assert [r.option for r in options if r.filter == "region"] == ["APAC", "EMEA", "LATAM", "UNMAPPED"]


def test_entitlement(spark, sample):
    mapping = spark.createDataFrame(
        [("ana", "EMEA"), ("ana", "EMEA"), ("ben", "APAC")], "user string, region string"
    )
    seen = measures.entitled(sample.mart, mapping, "ana")
    assert {r.region for r in seen.collect()} == {"EMEA"}
    assert seen.count() == sample.mart.where("region = 'EMEA'").count()
    assert measures.entitled(sample.mart, mapping, "eve").count() == 0


def test_unplanned_region_has_no_percentage(sample):
    rows = by(measures.variance_by_region(sample.mart), "region")
    assert rows["UNMAPPED"].forecast is None and rows["UNMAPPED"].variance_pct is None
    assert rows["UNMAPPED"].actual == rows["UNMAPPED"].variance == 39
    assert rows["LATAM"].variance_pct == D("-1.0000")


def test_flag_order(sample):
    flags = [r.variance_flag for r in measures.variance_by_flag(sample.mart).collect()]
    assert flags == ["NO_ACTUALS", "BELOW_PLAN", "AT_OR_ABOVE_PLAN", "NO_FORECAST"]


def test_headline(sample):
    row = measures.headline_kpis(sample.mart).first()
    assert row.total_rows == sample.mart.count() and row.no_actuals_rows == 2
    assert row.unmapped_revenue == D("39.00")
    assert row.revenue_variance == row.actual_revenue - row.forecast_revenue
    assert row.on_time_count == row.arrived_count - 2
    nothing = measures.headline_kpis(sample.mart.where("false")).first()
    assert nothing.total_rows == 0 and nothing.on_time_rate is None


def test_one_good_month_outranks_the_rest(sample):
    cells = {(r.product_id, r.region): r.cell_flag for r in measures.flag_cells(sample.mart).collect()}
    assert cells[("P1", "EMEA")] == "AT_OR_ABOVE_PLAN"
    assert cells[("P1", "LATAM")] == "NO_ACTUALS"
    assert cells[("P1", "UNMAPPED")] == "NO_FORECAST"
    regions = ["APAC", "EMEA", "LATAM", "UNMAPPED"]
    pivot = by(measures.flag_pivot(sample.mart, regions), "product_id")
    with pytest.raises(Exception, match="region is not listed: APAC"):
        measures.flag_pivot(sample.mart, regions[1:]).collect()
    wide = by(measures.composition_pivot(sample.mart, regions), "product_id")
    assert wide["P1"].LATAM == "Jan 2025: NO_ACTUALS" and wide["P9"].LATAM == ""
    assert pivot["P1"].LATAM == "NO_ACTUALS" and pivot["P9"].LATAM is None


def test_composition_reads_in_month_order(sample):
    text = {
        (r.product_id, r.region): r.composition
        for r in measures.cell_composition(sample.mart).collect()
    }
    assert text[("P1", "EMEA")] == "Jan 2025: AT_OR_ABOVE_PLAN; Mar 2025: NO_FORECAST"
    assert text[("P1", "APAC")] == "Jan 2025: BELOW_PLAN; Apr 2025: BELOW_PLAN"


def test_flags_counted_at_two_grains(sample):
    counts = {
        (r.grain, r.variance_flag): r.flag_count
        for r in measures.flag_counts_two_grains(sample.mart).collect()
    }
    assert sum(n for (grain, _), n in counts.items() if grain == "month") == sample.mart.count()
    assert counts[("cell", "AT_OR_ABOVE_PLAN")] < counts[("month", "AT_OR_ABOVE_PLAN")] + 1


def test_delivery(sample):
    orders = sample.fct_orders
    gap = by(measures.delivery_gap(orders), "region")
    # APAC: one late by a day, one without a promise
    assert gap["APAC"].worst_gap == 1 and gap["APAC"].orders == 1
    assert gap["ALL"].orders == sum(r.orders for k, r in gap.items() if k != "ALL")
    late = measures.late_orders(orders).collect()
    assert [r.order_id for r in late] == ["A3", "A4"] and late[0].days_late == 1
    rate = by(measures.on_time_by_region(orders), "region")
    assert rate["APAC"].on_time_rate == D("0.0000") and rate["EMEA"].on_time_rate == D("1.0000")
    counts = measures.contradiction_counts(orders).first()
    assert tuple(counts) == (3, 3, 1)
    distribution = by(measures.delivery_distribution(orders), "delivery_status")
    assert distribution["Not Delivered"].order_count == 1
    degraded = {r.order_id for r in measures.degraded_orders(orders).collect()}
    assert degraded == {"A5", "A9", "ORD9-1", "ORD9-2"}


def test_margin(sample):
    row = measures.margin_coverage(sample.fct_orders).first()
    assert row.order_count - row.orders_with_known_cost == 1
    assert row.total_margin == sum(r.actual_margin for r in sample.mart.collect())
    products = by(
        measures.margin_by_product(sample.mart, sample.fct_orders, sample.dim_product), "product_id"
    )
    assert products["P9"].margin_coverage == D("0.0000")
    assert products["P1"].product_name == "Widget"
    nameless = by(
        measures.margin_by_product(
            sample.mart, sample.fct_orders, sample.dim_product.where("product_id = 'P1'")
        ),
        "product_id",
    )
    assert nameless["P2"].product_name == "P2"
    assert [r.order_id for r in measures.uncovered_orders(sample.fct_orders).collect()] == ["ORD9-2"]
    assert by(measures.uncovered_products(sample.fct_orders), "product_id")["P9"].order_count == 1


def test_products(sample):
    assert sum(r.product_count for r in measures.lifecycle_counts(sample.dim_product).collect()) == 3
    assert [r.product_id for r in measures.product_list(sample.dim_product).collect()] == ["P1", "P2", "P3"]


def test_top_k(sample):
    worst = measures.worst_variance(sample.mart, 3).collect()
    assert worst[0].revenue_variance == D("-488.00") and len(worst) == 3
    both = measures.top_bottom_variance(sample.mart, 2).collect()
    assert sorted(r.side for r in both) == ["above", "above", "below", "below"]


def test_measures_are_ratios_of_sums(sample):
    star = measures.star(sample.cells, sample.dim_product, sample.dim_region, sample.dim_date)
    assert star.count() == sample.mart.count()
    total = measures.measures(star).first()
    row = measures.headline_kpis(sample.mart).first()
    assert (total.actual_revenue, total.variance_pct) == (row.actual_revenue, row.variance_pct)
    families = by(measures.measures(star, "product_family"), "product_family")
    assert families["Unknown"].variance_pct is None
    assert families["Unknown"].margin_coverage_pct == D("0.0000")


def test_orders_by_customer_attribute(sample):
    rows = by(
        measures.orders_by_customer_attribute(sample.fct_orders, sample.dim_customer, "segment"),
        "segment",
    )
    assert rows["Unknown"].order_count == 1
    assert sum(r.order_count for r in rows.values()) == sample.orders.count()


def test_every_query_has_a_twin():
    from planlens.plans.oracle import ORACLE_SQL

    assert set(QUERIES) == set(ORACLE_SQL)


def test_month_filter_reaches_the_scan(spark, sample, tmp_path):
    sample.mart.write.partitionBy("revenue_month").parquet(str(tmp_path / "mart"))
    stored = spark.read.parquet(str(tmp_path / "mart"))
    chosen = measures.apply_filters(
        stored, sample.dim_product, regions=["EMEA"], months=("2025-01-01", "2025-02-01")
    )
    plan = chosen.select("actual_revenue")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(revenue_month" in plan
    assert "PushedFilters: [IsNotNull(region), EqualTo(region,EMEA)]" in plan
    assert chosen.where(F.col("revenue_month") > "2025-02-01").count() == 0
