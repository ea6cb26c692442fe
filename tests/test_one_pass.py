"""Checks and reconciliation from one read of each table, held against those that read one by one."""

import pytest
from pyspark.sql import functions as F

from planlens.operators import checks, measures


@pytest.fixture(scope="module")
def tables(spark):
    child = [(k % 7, f"p{k % 5}", "x" if k % 3 else None, k) for k in range(60)] + [(None, None, None, 99), (1, "lost", "y", 3)]
    parent = [(f"p{k}", k) for k in range(4)] + [(None, 9), ("p0", 10)]
    return {
        "child": spark.createDataFrame(child, "a int, parent string, b string, c int"),
        "parent": spark.createDataFrame(parent, "id string, n int"),
        "empty": spark.createDataFrame([], "id string, n int"),
    }


def one_by_one(tables, check):
    df = tables[check.table]
    if isinstance(check, checks.Rows):
        return df.where(check.condition).count()
    if isinstance(check, checks.Unique):
        return checks.not_unique(df, *check.columns).count()
    orphans = checks.without_parent(df, check.column, tables[check.parent], check.parent_column)
    return orphans.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def suite():
    return [
        checks.Rows("b missing", "child", checks.is_missing("b")),
        checks.Rows("b accepted", "child", checks.is_unaccepted("b", ["x"])),
        checks.Rows("never", "child", checks.is_missing("c") & F.lit(False)),
        checks.Unique("a", "child", ("a",)), checks.Unique("a and b", "child", ("a", "b")),
        checks.Unique("a, parent and c", "child", ("a", "parent", "c")), checks.Unique("id", "parent", ("id",)),
        checks.Unique("none", "empty", ("id",)), checks.Orphans("orphans", "child", "parent", "parent", "id"),
        checks.Orphans("all orphans", "child", "parent", "empty", "id"),
        checks.Orphans("no child", "empty", "id", "parent", "id"),
        checks.Orphans("own parent", "parent", "id", "parent", "id"),
        checks.Orphans("by number", "parent", "n", "child", "c"),
    ]


def test_all_checks_are_those_read_one_by_one(tables):
    listed = suite()
    rows = checks.in_one_pass(tables, listed).collect()
    got = {r.check_name: r.failing_rows for r in rows}
    assert len(rows) == len(listed)
    assert got == {c.name: one_by_one(tables, c) for c in listed}
    assert sum(n > 0 for n in got.values()) >= 7


def test_each_table_is_read_once(spark, tmp_path):
    for name in ("child", "parent"):
        spark.range(10).selectExpr("id as a", "id as b", "id as c").write.parquet(f"{tmp_path}/{name}")
    stored = {name: spark.read.parquet(f"{tmp_path}/{name}") for name in ("child", "parent")}
    found = checks.in_one_pass(stored, [
        checks.Unique("a", "child", ("a",)), checks.Unique("b", "child", ("b", "c")),
        checks.Orphans("a in parent", "child", "a", "parent", "a"), checks.Orphans("b in parent", "child", "b", "parent", "b"),
        checks.Rows("missing", "child", checks.is_missing("c")), checks.Unique("parent", "parent", ("a",)),
    ])
    plan = found._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("FileScan parquet") == 2
    assert {r.failing_rows for r in found.collect()} == {0}


def test_checks_of_the_same_columns_share_a_record_of_each_row(tables):
    """Also more checks than a subject has bits, and keys that are parents of their own."""
    many = [checks.Rows(f"c is {n}", "child", F.col("c") == n) for n in range(70)]
    many += [checks.Orphans(f"orphans {n}", "child", "parent", ("parent", "empty")[n % 2], "id") for n in range(70)]
    many += [checks.Unique("parent", "child", ("parent",)), *suite()]
    found = checks.in_one_pass(tables, many)
    got = {r.check_name: r.failing_rows for r in found.collect()}
    names = {c.name: c for c in many}
    for name in ("parent", "orphans", "all orphans", "own parent", *list(names)[:140:9], list(names)[139]):
        assert got[name] == one_by_one(tables, names[name]), name
    assert len(got) == len(many) and got["b missing"] == one_by_one(tables, suite()[0])
    # Conditions and keys are compiled: no function over arrays is interpreted per row.
    few = checks.in_one_pass(tables, [checks.Orphans(f"{n}", "child", "parent", "parent", "id") for n in "ab"])
    plan = few._jdf.queryExecution().optimizedPlan().toString()
    assert "lambda" not in plan and plan.count("struct(subject, 0, offered, 0,") == 1


def test_no_checks_are_refused(tables):
    with pytest.raises(ValueError):
        checks.in_one_pass(tables, [])


def test_reconciliation_in_two_passes_is_that_of_stored_layers(sample):
    amounts = measures.reconciliation_amounts(
        measures.source_lines(sample.raw_orders), sample.mart, sample.fct_orders, sample.rejects
    )
    totals = sample.reconciliation_totals(
        recognised={"recognised": F.lit(True), "none": F.lit(False)}, more=F.trim("quantity")
    )
    expected = measures.reconciliation(amounts).first().asDict()
    row = totals.first()
    assert row.none == 0 and row.more == row.source
    assert measures.explained(totals.drop("none", "more")).first().asDict() == expected


def test_lost_and_multiplied_revenue_shows(sample):
    totals = sample.reconciliation_totals(recognised={
        "recognised": F.col("region") != "EMEA", "whole": F.lit(True),
    })
    row = measures.explained(totals).first()
    assert row.unexplained == row.whole - row.recognised > 0


def test_relationships_store_the_flagged_lines_alone(spark, monkeypatch):
    """The rollup is stored, and no other plan reads the enriched lines."""
    from planlens.plans import pipeline
    from planlens.plans.queries import QUERIES

    stored, settle = [], pipeline.settle
    monkeypatch.setattr(pipeline, "settle", lambda df: stored.append(df.columns) or settle(df))
    assert QUERIES["check_relationships"](spark, "/root/testdata/sf0.001").count() == 7
    assert len(stored) == 1 and "dq_failure_reason" in stored[0]
