"""Every registered query against its SQL twin, on the smallest test tables."""

from pathlib import Path

import pytest

from compare import difference, oracle_connection
from planlens.plans.oracle import ORACLE_SQL
from planlens.plans.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="test tables not mounted")


@pytest.fixture(scope="module")
def connection():
    return oracle_connection(SF_DIR)


@pytest.mark.parametrize("key", QUERIES)
def test_query_matches_sql(spark, connection, key):
    assert difference(QUERIES[key](spark, SF_DIR), connection, ORACLE_SQL[key]) is None


@pytest.mark.parametrize(
    "key", ["orders_flagged", "plan_vs_actual", "filtered_orders", "star_rollup"]
)
def test_query_matches_sql_without_broadcasts(spark, connection, key):
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert difference(QUERIES[key](spark, SF_DIR), connection, ORACLE_SQL[key]) is None
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)


def test_planning_runs_no_job(spark):
    QUERIES["plan_vs_actual"](spark, SF_DIR)  # lands the extracts
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("planning", "")
    QUERIES["plan_vs_actual"](spark, SF_DIR)
    QUERIES["star_rollup"](spark, SF_DIR)
    assert list(tracker.getJobIdsForGroup("planning")) == []
    spark.sparkContext.setJobGroup("", "")


@pytest.mark.parametrize("key", ["filtered_mart", "entitled_mart"])
def test_filters_go_below_the_plan_join(spark, key):
    plan = QUERIES[key](spark, SF_DIR)._jdf.queryExecution().optimizedPlan().toString()
    above = plan.split("Join FullOuter")[0] if "Join FullOuter" in plan else plan
    assert "ASIA" not in above and "LeftSemi" not in above


@pytest.mark.parametrize("key", ["reconciliation", "margin_by_product"])
def test_lines_are_cast_once(spark, key):
    """The result's plan reads stored copies, and the landed lines for the source total only."""
    plan = QUERIES[key](spark, SF_DIR)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("try_cast") <= 4  # of the raw text's price and quantity
    assert plan.count("plant_location") <= 1
