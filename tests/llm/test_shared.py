"""What the operators share: components, samples, Bloom filter, running totals."""

import random
import zlib
from collections import defaultdict

from pyspark.sql import functions as F

from planlens.llm import bloom, sampling
from planlens.llm.components import components
from planlens.llm.ordering import placed, running_totals


def test_components_are_those_of_union_find(spark):
    rng = random.Random(6)
    edges = [(f"n{rng.randrange(300)}", f"n{rng.randrange(300)}") for _ in range(220)]
    edges += [("hub", f"h{i:03d}") for i in range(200)] + [(f"c{i:03d}", f"c{i + 1:03d}") for i in range(60)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        root[find(a)] = find(b)
    groups = defaultdict(set)
    for a, b in edges:
        if a != b:
            groups[find(a)] |= {a, b}
    expected = {n: min(g) for g in groups.values() for n in g}
    got = components(spark.createDataFrame(edges, "a string, b string")).collect()
    assert {r.node: r.root for r in got} == expected and len(got) == len(expected)
    assert components(spark.createDataFrame([("x", "x")], "a string, b string")).collect() == []


def test_sample_is_the_first_of_each_label_by_hash(spark):
    rows = [(i, i % 10 == 0) for i in range(2000)] + [(None, True), (5000, None), (7, True)]
    frame = spark.createDataFrame(rows, "doc_id long, label boolean")
    got = sampling.ids_per_label(frame, 30)
    hashed = {r.doc_id: r.h for r in spark.range(2000).select(
        F.col("id").alias("doc_id"), F.xxhash64("id").alias("h")).collect()}
    for label in (True, False):
        mine = [i for i in range(2000) if (i % 10 == 0) == label]
        first = sorted(mine, key=lambda i: (hashed[i], i))[:30]
        assert sorted(r.doc_id for r in got.collect() if r.label == label) == sorted(first)


def test_fold_is_the_crc_of_the_id_as_text(spark):
    frame = spark.createDataFrame([(i,) for i in (*range(50), None)], "doc_id long")
    for r in frame.select("doc_id", sampling.fold(F.col("doc_id"), 5).alias("f")).collect():
        assert r.f == zlib.crc32(b"" if r.doc_id is None else str(r.doc_id).encode()) % 5


def test_bloom_filter_misses_no_key(spark):
    docs = spark.range(20_000).select(F.concat(F.lit("k"), "id").alias("key"))
    marked = bloom.marked(docs, F.col("key"), docs.where("key like '%7'"), "maybe")
    rows = {r.key: r.maybe for r in marked.collect()}
    assert len(rows) == 20_000 and all(v for k, v in rows.items() if k.endswith("7"))
    assert sum(rows.values()) < 2_100
    none = bloom.marked(docs, F.col("key"), docs.limit(0), "maybe")
    assert none.where("maybe").count() == 0


def test_running_totals_over_a_hot_group(spark):
    rng = random.Random(2)
    rows = [(rng.choice(["hot", "hot", None, "b"]), i, rng.randrange(9)) for i in rng.sample(range(5000), 900)]
    frame = spark.createDataFrame(rows, "g string, k long, v long")
    got = running_totals(placed(frame, ["g", "k"]), ["g"], ["k"], {"before": "v"}).collect()
    total = defaultdict(int)
    expected = {}
    for g, k, v in sorted(rows, key=lambda r: r[1]):
        expected[k] = total[g]
        total[g] += v
    assert {r.k: r.before for r in got} == expected
