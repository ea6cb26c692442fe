"""What moves or is stored for a query grows no faster than its tables."""

import os
from pathlib import Path

import pytest

from compare import difference, oracle_connection
from planlens.plans.oracle import ORACLE_SQL
from planlens.plans.queries import QUERIES
from planlens.session import shared_folder
from planlens.sources.testdata import SampleModel

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="test tables not mounted")


@pytest.fixture
def fresh(tmp_path):
    """The tables under a path of their own, of which nothing is landed yet."""
    os.symlink(SF_DIR, tmp_path / "tables")
    return str(tmp_path / "tables")


def stored(spark, kind):
    return {str(p) for p in Path(shared_folder(spark).removeprefix("file:")).glob(kind)}


def test_one_extract_is_written_alone_and_compressed(spark, fresh):
    before = stored(spark, "extracts/*/*") | stored(spark, "landed/*/*")
    assert difference(
        QUERIES["land_csv_orders"](spark, fresh), oracle_connection(fresh), ORACLE_SQL["land_csv_orders"]
    ) is None
    new = (stored(spark, "extracts/*/*") | stored(spark, "landed/*/*")) - before
    assert {Path(p).name for p in new} == {"oracle_orders.csv"}
    parts = [p for folder in new for p in Path(folder).glob("part-*")]
    assert parts and all(p.name.endswith(".csv.gz") for p in parts)


def test_lines_are_not_sorted_to_be_landed(spark, fresh):
    plan = SampleModel(spark, fresh)._derive_orders()._jdf.queryExecution().sparkPlan().toString()
    assert "SortMergeJoin" not in plan and plan.count("ShuffledHashJoin") == 3


def test_actuals_and_plan_share_one_stored_rollup(spark, fresh):
    """The lines are typed for the rollup, once; the mart reads cells."""
    plan = QUERIES["plan_vs_actual"](spark, fresh)._jdf.queryExecution().optimizedPlan().toString()
    assert "raw_oracle_orders" not in plan and "plant_location" not in plan


def test_long_list_of_repeated_ids_moves_no_line(spark, fresh):
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for key in ("orders_rejects", "star_rollup", "layer_row_counts"):
            assert difference(QUERIES[key](spark, fresh), oracle_connection(fresh), ORACLE_SQL[key]) is None
        plan = QUERIES["orders_flagged"](spark, fresh)._jdf.queryExecution().sparkPlan().toString()
        assert "_block0" in plan  # lines meet the filter first
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)


def test_layers_are_counted_without_a_copy_of_the_enriched_lines(spark, fresh):
    before = stored(spark, "settled/*")
    frame = QUERIES["layer_row_counts"](spark, fresh)
    assert difference(frame, oracle_connection(fresh), ORACLE_SQL["layer_row_counts"]) is None
    columns = [spark.read.parquet(p).columns for p in stored(spark, "settled/*") - before]
    assert columns and not any("gross_margin" in c for c in columns)


def test_rejects_are_sorted_from_a_stored_copy(spark, fresh):
    frame = QUERIES["orders_rejects"](spark, fresh)
    plan = frame._jdf.queryExecution().optimizedPlan().toString()
    assert "try_cast" not in plan and "plant_location" not in plan  # lines are typed before
    assert difference(frame, oracle_connection(fresh), ORACLE_SQL["orders_rejects"]) is None
