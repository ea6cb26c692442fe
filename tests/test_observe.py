import json
from datetime import datetime
from decimal import Decimal as D

import pytest

from planlens.operators import observe
from planlens.sources.run_artifacts import corrupt_run_artifacts, read_run_artifacts

NOW = "2025-06-10 12:00:00"


def at(text):
    return datetime.fromisoformat(text)


def log(spark):
    rows = [
        ("fresh", at("2025-06-10 02:50:00"), "b3"), ("fresh", at("2025-06-09 02:50:00"), "b2"),
        ("stale", at("2025-06-09 05:00:00"), "b2"), ("dead", at("2025-06-08 11:59:00"), "b1"),
        ("edge", at("2025-06-09 06:00:00"), "b2"),
    ]
    return spark.createDataFrame(rows, "table_name string, _loaded_at timestamp, _batch_id string")


def test_freshness(spark):
    total = observe.load_freshness(log(spark)).first()
    assert (total.latest_batch_id, total.batch_count) == ("b3", 3)
    rows = {r.table_name: r for r in observe.freshness_by_source(log(spark), NOW).collect()}
    # 9 h 10 min ago, 10 hour boundaries crossed
    assert rows["fresh"].hours_since_load == 10
    assert (rows["fresh"].batches_seen, rows["fresh"].row_count) == (2, 2)
    verdict = {r.table_name: r for r in observe.freshness_verdict(log(spark), NOW).collect()}
    assert {k: r.verdict for k, r in verdict.items()} == {
        "fresh": "pass", "stale": "warn", "dead": "error", "edge": "pass",
    }
    assert verdict["edge"].age_hours == D("30.0000")


def test_load_log_tags_each_table(spark):
    part = log(spark).drop("table_name")
    assert {r.table_name for r in observe.load_log({"a": part, "b": part}).collect()} == {"a", "b"}


def jobs(spark):
    rows = [
        (1, "SUCCESS", at("2025-06-10 01:00:00"), 1500), (2, "FAIL", at("2025-06-10 01:00:00"), 2),
        (3, "FAIL", at("2025-06-03 11:59:59"), 10), (4, "SUCCESS", at("2025-06-03 12:00:00"), 7),
    ]
    df = spark.createDataFrame(
        rows, "query_id long, execution_status string, start_time timestamp, total_elapsed_time long"
    )
    return df.selectExpr(
        "*", "'q' as query_type", "'u' as user_name", "'r' as role_name", "'w' as warehouse_name",
        "cast(null as int) as error_code", "cast(null as string) as error_message",
    )


def test_jobs(spark):
    recent = observe.recent_jobs(jobs(spark), NOW).collect()
    assert [r.query_id for r in recent] == [2, 1, 4]
    assert recent[1].elapsed_seconds == D("1.500")
    assert [r.query_id for r in observe.recent_jobs(jobs(spark), NOW, limit=1).collect()] == [2]
    earlier = observe.recent_jobs(jobs(spark), "2025-06-10 00:59:59").collect()
    assert [r.query_id for r in earlier] == [4, 3]
    owned = jobs(spark).selectExpr("*", "if(query_id = 2, 'a', 'b') as database_name")
    assert [r.query_id for r in observe.recent_jobs(owned, NOW, database="b").collect()] == [1, 4]
    assert observe.failed_jobs(owned, NOW, database="b").count() == 0
    assert [r.query_id for r in observe.failed_jobs(jobs(spark), NOW).collect()] == [2]


def test_cost_by_day(spark):
    rows = [
        ("a", at("2025-06-10 01:00:00"), D("1.5")), ("a", at("2025-06-10 23:00:00"), D("2.0")),
        ("b", at("2025-06-09 01:00:00"), D("4.0")), ("a", at("2025-05-01 01:00:00"), D("9.0")),
    ]
    df = spark.createDataFrame(
        rows, "warehouse_name string, start_time timestamp, credits_used decimal(18,4)"
    ).selectExpr(
        "*", "credits_used as credits_used_compute", "credits_used as credits_used_cloud_services"
    )
    got = observe.cost_by_day(df, "2025-06-10 23:59:59").collect()
    assert [(r.warehouse_name, r.credits_used) for r in got] == [("a", D("3.5")), ("b", D("4.0"))]
    only = observe.cost_by_day(df, NOW, warehouses=["b"]).collect()
    assert [r.warehouse_name for r in only] == ["b"]


def test_table_sizes_skip_dropped_tables(spark, sample):
    stats = observe.table_stats({("RAW", "b"): sample.accounts, ("RAW", "a"): sample.products})
    rows = observe.table_sizes(stats).collect()
    assert [(r.table_name, r.row_count) for r in rows] == [("a", 3), ("b", 3)]
    assert all(r.active_bytes > 0 for r in rows)
    dropped = stats.selectExpr("* except (deleted)", "current_date() as deleted")
    assert observe.table_sizes(dropped).count() == 0
    here = observe.table_stats({("RAW", "b"): sample.accounts}, catalog="HERE")
    assert observe.table_sizes(here, catalog="HERE").count() == 1
    assert observe.table_sizes(here, catalog="THERE").count() == 0


def test_layer_counts(sample):
    counts = observe.layer_row_counts({
        ("staging", "orders"): sample.orders, ("raw", "orders"): sample.raw_orders,
    }).collect()
    assert [r.layer for r in counts] == ["raw", "staging"]
    assert counts[0].row_count > counts[1].row_count


def test_run_artifacts(spark, tmp_path):
    results = [
        {"unique_id": f"model.shop.m{i}", "status": "success", "execution_time": float(i)}
        for i in range(7)
    ] + [
        {"unique_id": "model.shop.bad", "status": "error", "execution_time": 0.1},
        {"unique_id": "test.shop.t1", "status": "pass", "execution_time": 99.0},
        {"unique_id": "test.shop.t2", "status": "fail", "execution_time": 0.1},
    ]
    document = {
        "metadata": {"generated_at": "2025-06-10T01:00:00Z", "other": 1},
        "elapsed_time": 12.5, "results": results,
    }
    (tmp_path / "run.json").write_text(json.dumps(document, indent=2))
    artifacts = read_run_artifacts(spark, str(tmp_path / "run.json"))
    row = observe.run_summary(artifacts).first()
    assert (row.models_ok, row.models_total) == (7, 8)
    assert (row.tests_passed, row.tests_total, row.tests_failed) == (1, 2, 1)
    assert row.elapsed_time == 12.5
    slowest = observe.slowest_models(artifacts).collect()
    assert [r.model for r in slowest] == ["m6", "m5", "m4", "m3", "m2"]


@pytest.mark.parametrize("multi_line", [True, False])
def test_what_is_no_artifact_is_told_apart(spark, tmp_path, multi_line):
    good = {"metadata": {"generated_at": "2025-06-10T01:00:00Z"}, "elapsed_time": 1.5, "results": []}
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "one.json").write_text(json.dumps(good))
    (tmp_path / "a" / "two.json").write_text('{"metadata": ')
    folder = str(tmp_path / "a")
    rows = read_run_artifacts(spark, folder, multi_line=multi_line).collect()
    assert [(r.elapsed_time, r.results) for r in rows] == [(1.5, [])]
    broken = corrupt_run_artifacts(spark, folder, multi_line=multi_line).collect()
    assert [(r.file.rpartition("/")[2], r.text.strip()) for r in broken] == [("two.json", '{"metadata":')]
