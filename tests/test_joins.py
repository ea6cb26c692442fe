import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from planlens.operators import joins, quality
from planlens.operators.conform import type_orders


@pytest.fixture(scope="module")
def facts(spark):
    """A third of the rows on one key, some on none, some on a key no dimension has."""
    rng = random.Random(7)
    keys = ["hot"] * 400 + [None] * 300 + ["absent"] * 200 + [f"k{rng.randrange(60)}" for _ in range(300)]
    return spark.createDataFrame(list(zip(keys, range(len(keys)))), "key string, v int")


@pytest.fixture(scope="module")
def dim(spark):
    rows = [("hot", 1, "a")] + [(f"k{i}", i, None if i % 5 else "b") for i in range(50)]
    return spark.createDataFrame(rows, "key string, x int, y string")


@pytest.fixture
def no_broadcast(spark):
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)


def plan_of(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_lookup_keeps_every_fact_once(facts, dim):
    found = {r.v: r for r in joins.lookup(facts, dim, "key").collect()}
    assert len(found) == facts.count()
    known = {r.key: r for r in dim.collect()}
    for r in found.values():
        expected = known.get(r.key)
        assert (r.x, r.y) == ((expected.x, expected.y) if expected else (None, None))


def test_small_dimension_is_broadcast_and_a_large_one_is_not(facts, dim, spark):
    joined = joins.lookup(facts, dim, "key")
    expected = sorted(map(repr, joined.collect()))
    assert "BroadcastHashJoin" in plan_of(joined)
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        shuffled = joins.lookup(facts, dim, "key")
        assert sorted(map(repr, shuffled.collect())) == expected
        assert "Broadcast" not in plan_of(shuffled)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)


def test_several_large_lookups_read_the_facts_once(spark, tmp_path, facts, dim, no_broadcast):
    facts.withColumn("other", F.concat(F.lit("k"), (F.col("v") % 70).cast("string"))).write.parquet(
        f"{tmp_path}/facts"
    )
    stored = spark.read.parquet(f"{tmp_path}/facts")
    second = dim.select(F.col("key").alias("other"), F.col("x").alias("z"))
    got = joins.lookups(stored, {"key": dim, "other": second})
    assert got.count() == facts.count()
    assert plan_of(got).split("Initial Plan")[0].count("FileScan parquet") == 1


def test_a_hot_key_is_split_over_tasks(spark, tmp_path, dim, no_broadcast):
    """AQE deals the partition of a hot key out, with its bounds set low."""
    keys = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), (F.col("id") % 50).cast("string")))
    spark.range(400_000, numPartitions=8).select(
        keys.alias("key"), F.sha2(F.col("id").cast("string"), 256).alias("v")
    ).write.parquet(f"{tmp_path}/facts")
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1m",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1m",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    kept = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        joined = joins.lookup(spark.read.parquet(f"{tmp_path}/facts"), dim, "key")
        assert "skew=true" in plan_of(joined)
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)


@pytest.mark.parametrize("large", [True, False])
def test_flagging_equals_a_window_count(spark, large, request):
    """Hot, missing and ordinary repeated ids, against the window it stands for."""
    if large:
        request.getfixturevalue("no_broadcast")
    rng = random.Random(3)
    ids = ["hot"] * 500 + [""] * 300 + [f"o{rng.randrange(500)}" for _ in range(400)]
    raw = spark.createDataFrame(
        [(i, "C", "P", "2025-01-01", "", "", str(n % 7), "1.00", "a, b", "Open")
         for n, i in enumerate(ids)],
        "order_id string, customer_id string, product_id string, order_date string, "
        "promised_delivery_date string, actual_delivery_date string, quantity string, "
        "unit_price string, plant_location string, order_status string",
    )
    typed = type_orders(raw)
    flagged = quality.flag_orders(typed, quality.duplicate_ids(typed))
    repeated = F.count("*").over(Window.partitionBy("order_id")) > 1
    expected = typed.withColumn("dup", repeated).groupBy("order_id", "dup").count()
    is_dup = F.coalesce(F.col("dq_failure_reason") == "AMBIGUOUS_DUPLICATE", F.lit(False))
    got = flagged.withColumn("dup", is_dup).groupBy("order_id", "dup").count()
    assert sorted(map(repr, got.collect())) == sorted(map(repr, expected.collect()))
