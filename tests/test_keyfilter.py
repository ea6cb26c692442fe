"""The Bloom filter before the quarantine of repeated ids."""

import pytest

import fixtures
from planlens.operators import conform, keyfilter, quality
from planlens.session import settle


@pytest.fixture(scope="module")
def lines(spark):
    rows = [(f"ID{k % 970}", f"{k % 7}") for k in range(1000)] + [(None, "1"), (None, "2"), (" x ", "3")]
    columns = fixtures.sample_pipeline(spark).raw_orders
    frame = spark.createDataFrame(rows, "order_id string, quantity string")
    for c in columns.columns:
        if c not in frame.columns:
            frame = frame.selectExpr("*", f"cast(null as string) as `{c}`")
    return conform.type_orders(frame.select(*columns.columns))


def test_no_listed_key_is_cleared(spark):
    keys = spark.range(5000).selectExpr("concat('k', id) as key")
    bits = keyfilter.bits_for(5000)
    listed = keyfilter.key_filter(keys, "key", bits)
    both = spark.range(10000).selectExpr("concat('k', id) as key", "id")
    marked = keyfilter.maybe_listed(both, both["key"], listed, bits, "maybe")
    rows = marked.collect()
    assert len(rows) == 10000 and all(r.maybe for r in rows if r.id < 5000)
    assert sum(r.maybe for r in rows if r.id >= 5000) < 250
    none = keyfilter.key_filter(keys.limit(0), "key", bits)
    assert not any(r.maybe for r in keyfilter.maybe_listed(both, both["key"], none, bits, "maybe").collect())


def test_size_is_bounded():
    assert keyfilter.bits_for(0) == keyfilter.bits_for(1000) == 1 << 16
    assert keyfilter.bits_for(10**6) == 1 << 24
    assert keyfilter.bits_for(10**12) == keyfilter.MAX_BITS


@pytest.mark.parametrize("bits", [1 << 16, 1 << 20])
def test_the_filter_changes_no_verdict(lines, bits):
    duplicates = settle(quality.duplicate_ids(lines))
    plain = sorted(map(repr, quality.flag_orders(lines, duplicates).collect()))
    assert sorted(map(repr, quality.flag_orders(lines, duplicates, filter_bits=bits).collect())) == plain
    assert sum("AMBIGUOUS_DUPLICATE" in r for r in plain) == 62


def test_lines_are_shuffled_only_below_the_filter(spark, lines):
    duplicates = settle(quality.duplicate_ids(lines))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        bits = quality.filter_bits(duplicates)
        assert bits == 1 << 16
        plan = quality.flag_orders(lines, duplicates, filter_bits=bits)._jdf.queryExecution().sparkPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    clear, suspects = plan.split("SortMergeJoin")[0], plan.split("SortMergeJoin")[1]
    assert "_words0" in suspects and "BroadcastHashJoin" in clear
    assert quality.filter_bits(duplicates) is None  # a short list is broadcast
