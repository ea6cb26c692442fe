import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from planlens.llm import curriculum as cu


def targets_by_rounds(sizes, weights, share=1.5, cap=2.0):
    """Share by weight, cut to the cap, and share the excess again until none is above."""
    left, open_, out = share * sum(sizes), set(range(len(sizes))), [0.0] * len(sizes)
    while True:
        total = sum(weights[i] for i in open_)
        for i in open_:
            out[i] = left * weights[i] / total
        over = {i for i in open_ if out[i] > cap * sizes[i]}
        if not over:
            return out
        for i in over:
            out[i] = cap * sizes[i]
            left -= out[i]
        open_ -= over


@pytest.mark.parametrize("sizes", [[10, 1000, 5], [1, 1, 1, 1], [0, 50, 0, 7, 900, 3, 3], [4], [0, 0]])
def test_targets_are_the_shared_out_rest(spark, sizes):
    names = [f"s{i}" for i in range(len(sizes) - 1)] + [None]
    frame = spark.createDataFrame(list(zip(names, sizes)), "source string, source_size long")
    got = {r.source: r.target for r in cu.source_targets(frame).collect()}
    expected = targets_by_rounds(sizes, [(3, 1, 2)[i % 3] for i in range(len(sizes))]) if sum(sizes) else [0] * len(sizes)
    assert [got[n] for n in names] == pytest.approx(expected, abs=1e-5)


@pytest.fixture(scope="module")
def docs():
    rng = np.random.default_rng(8)
    out = [(i, " ".join("w" * rng.integers(0, 60)), f"s{min(rng.integers(9), 4)}") for i in range(300)]
    return out + [(300, None, "s1"), (301, "a b", None), (None, "x y z", "s2"), (5, "same id", "s2"), (7, "r r", "s0"), (7, "r r", "s0")]


def test_words_taken_meet_targets_and_positions_integrate_schedules(spark, docs):
    frame = spark.createDataFrame(docs, "doc_id long, text string, source string")
    placed = cu.place_documents(frame.select("doc_id", "source", cu.word_count(F.col("text")).alias("size"))).collect()
    assert len(placed) == len(docs)
    by_source = {}
    for r in placed:
        by_source.setdefault(r.source, []).append(r)
        assert r.taken == sum(c["words"] for c in r.copies) <= 2 * r.size
        assert all(0 < c["position"] <= 1 for c in r.copies)
    for rows in by_source.values():
        target, slope = rows[0].target, rows[0].slope
        assert sum(r.size for r in rows) == rows[0].source_size
        assert sum(r.taken for r in rows) == math.floor(target)
        # Up to time t a source's words follow the integral of its schedule.
        for t in (0.25, 0.5, 0.75):
            due = sum(c["words"] for r in rows for c in r.copies if c["position"] <= t)
            assert due == pytest.approx(target * (t + slope * (t * t - t)), abs=62)
    again = cu.place_documents(frame.repartition(7).select("doc_id", "source", cu.word_count(F.col("text")).alias("size")))
    assert sorted(map(str, again.collect())) == sorted(map(str, placed))


def test_order_depends_on_ids_alone(spark):
    rows = [(i, "s", 10) for i in range(50)]
    placed = cu.place_documents(spark.createDataFrame(rows, "doc_id long, source string, size long")).collect()
    first = sorted(placed, key=lambda r: r.copies[0]["position"])
    assert [r.doc_id for r in first] == sorted(range(50), key=lambda i: hashlib.md5(str(i).encode()).hexdigest())


def test_stream_is_sorted_and_keeps_columns(spark, docs):
    frame = spark.createDataFrame([(*d, 1, "x", 9) for d in docs],
        "doc_id long, text string, source string, target int, _row string, mix_copy long")
    stream = cu.mix(frame).collect()
    assert [r.mix_position for r in stream] == sorted(r.mix_position for r in stream)
    assert stream[0].asDict().keys() >= {"target", "_row", "mix_words", "mix_copy"}
    assert {r._row for r in stream} == {"x"} and {r.mix_copy for r in stream} <= {0, 1}
    sized = frame.select("doc_id", "source", cu.word_count(F.col("text")).alias("size"))
    words = sum(r.taken for r in cu.place_documents(sized).collect())
    assert sum(r.mix_words for r in stream) == words
    assert all(r.mix_words <= len(r.text.split()) for r in stream)


def test_empty_table(spark):
    frame = spark.createDataFrame([], "doc_id long, text string, source string")
    assert cu.mix(frame).collect() == []


@pytest.mark.parametrize("rows", [
    [(1, None, "none"), (2, "", "none"), (3, "a b c d", "some"), (4, "e f", None)],
    [(1, None, "none"), (2, "", "none"), (3, " ", None)],
    [(1, "w " * 400_000, "long"), (2, None, "none"), (3, "w", "long")],
])
def test_sources_without_words(spark, rows):
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    sized = frame.select("doc_id", "source", cu.word_count(F.col("text")).alias("size"))
    placed = {r.doc_id: r for r in cu.place_documents(sized).collect()}
    assert sorted(placed) == [r[0] for r in rows]
    for i, text, _ in rows:
        size = len((text or "").split())
        assert placed[i].size == size and placed[i].taken <= 2 * size
        assert all(c.position is not None for c in placed[i].copies)
    mixed = cu.mix(frame.withColumn("MIX_WORDS", F.lit(1)))
    assert "MIX_WORDS" not in mixed.columns
    taken = [(r.doc_id, r.mix_words) for r in mixed.collect()]
    assert sum(n for _, n in taken) == sum(r.taken for r in placed.values())
