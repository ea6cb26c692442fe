"""Totals to the cent: of the hand-written extracts, worked out by hand, and of the original
extracts, as published, where PLANLENS_EXTRACTS names their folder."""

import os
from decimal import Decimal as D

import pytest

import fixtures
from planlens.operators import measures
from planlens.plans.build import build
from test_landing_build import ACCOUNTS, DOMAINS, ORDERS, PRODUCTS

EXTRACTS = os.environ.get("PLANLENS_EXTRACTS")


def every_dollar(spark):
    return measures.reconciliation(measures.reconciliation_amounts(
        measures.source_lines(spark.table("raw.raw_oracle_orders")),
        spark.table("analytics.mart_revenue_performance"),
        spark.table("analytics.fct_orders"),
        spark.table("staging.stg_oracle__orders_rejects"),
    )).first()


def rejects(spark):
    rows = spark.table("analytics.dq_reject_summary").collect()
    return {r.dq_failure_reason: r.rejected_row_count for r in rows}


@pytest.fixture(scope="module")
def own(spark, tmp_path_factory):
    folder = fixtures.write_extracts(
        tmp_path_factory.mktemp("own"), orders=ORDERS, accounts=ACCOUNTS, products=PRODUCTS
    )
    return build(spark, folder, domains=DOMAINS, expected_backdated=2)


def test_own_rows_and_rejects(spark, own):
    assert spark.table("analytics.fct_orders").count() == 15
    assert rejects(spark) == {
        "AMBIGUOUS_DUPLICATE": 7, "MISSING_ORDER_DATE": 3, "MISSING_UNIT_PRICE": 1,
        "INVALID_QUANTITY": 3,
    }


def test_own_dollars(spark, own):
    # B3 is 100 pieces at 1.005, which the source publishes as 1.01.
    row = every_dollar(spark)
    assert (row.recognised, row.open, row.cancelled, row.other, row.rejected) == (
        D("507.00"), D("100.00"), D("200.00"), D("0.00"), D("585.00"))
    assert row.source == row.accounted == D("1392.00")


if EXTRACTS:

    @pytest.fixture(scope="module")
    def results(spark):
        return build(spark, EXTRACTS, expected_backdated=1)

    def test_all_checks_pass(results):
        assert {r.status for r in results.collect()} == {"pass"}

    def test_row_counts(spark, results):
        def rows(table):
            return spark.table(table).count()

        assert rows("raw.raw_oracle_orders") == 128
        assert rows("staging.stg_oracle__orders") == rows("analytics.fct_orders") == 122
        assert rows("staging.stg_oracle__orders_rejects") == 6
        assert rows("analytics.fct_forecast") == 287
        assert rows("analytics.dim_date") == 12
        flags = spark.table("analytics.mart_revenue_performance").groupBy("variance_flag").count()
        assert {r.variance_flag: r["count"] for r in flags.collect()} == {
            "NO_ACTUALS": 187, "BELOW_PLAN": 89, "AT_OR_ABOVE_PLAN": 11, "NO_FORECAST": 2,
        }

    def test_rejects(spark, results):
        assert rejects(spark) == {
            "AMBIGUOUS_DUPLICATE": 2, "INVALID_QUANTITY": 2, "MISSING_ORDER_DATE": 1,
            "MISSING_UNIT_PRICE": 1,
        }

    def test_every_source_dollar(spark, results):
        row = every_dollar(spark)
        assert row.source == row.accounted == D("9448724.11")
        assert row.recognised == D("6168239.01")
        assert row.open + row.cancelled == D("3006773.46")
        assert row.rejected == D("273711.64")

    def test_headline(spark, results):
        row = measures.headline_kpis(spark.table("analytics.mart_revenue_performance")).first()
        assert row.total_rows == 289 and row.variance_pct == D("-0.8429")
        counts = measures.contradiction_counts(spark.table("analytics.fct_orders")).first()
        assert counts.cancelled_orders == 13
