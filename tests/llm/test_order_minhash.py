import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from planlens.llm import order_minhash as om


def edited(rows):
    """{(id, text)} to the edited text and the next text, by the definition."""
    first = {}
    for i, t in sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1])):
        first.setdefault(i, t)
    ids = list(first)
    out = {}
    for i, t in rows:
        t = t or ""
        after = first[ids[(ids.index(i) + 1) % len(ids)]]
        q = len(t) // 4
        out[i, t] = t[:len(t) - q] + after[:q], after
    return out


def numbered_runs(text):
    w = [x for x in re.split(r"[\s\x85\xa0]+", text) if x]
    runs = [tuple(w[i:i + om.K]) for i in range(len(w) - om.K + 1)] if len(w) >= om.K else [tuple(w)] if w else []
    seen = {}
    out = []
    for r in runs:
        seen[r] = seen.get(r, -1) + 1
        out.append((r, seen[r]))
    return out


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(2)
    texts = [" ".join(f"w{rng.integers(300)}" for _ in range(rng.integers(1, 400))) for _ in range(40)]
    texts += [texts[0], texts[3], "", None, "  ", "a", "a b", "é漢😀 x y z", "r " * 3000, "line\nbreak\ttab x"]
    rows = [(int(i), t) for i, t in zip(rng.permutation(len(texts)) * 7, texts)]
    return rows + [(None, "null id"), (rows[5][0], "same id"), rows[6]]


def test_digests_and_bounds(spark, rows):
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, tokens string")
    got = om.compare_with_edit(docs).collect()
    expected = edited(rows)
    wanted = sorted(
        (str(i), len(t or ""), hashlib.sha256(expected[i, t or ""][0].encode()).hexdigest()) for i, t in rows
    )
    assert sorted((str(r.doc_id), r.n_chars, r.edited_sha256) for r in got) == wanted
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    by_text = {}
    ids = {i: t or "" for i, t in rows if (i, "same id") not in rows}
    for r in got:
        if r.doc_id in ids:
            assert by_text.setdefault(ids[r.doc_id], r.fingerprint) == r.fingerprint
    long = [r for r in got if r.n_chars > 800]
    assert np.mean([r.near_edited for r in long]) > 0.3 > np.mean([r.near_next for r in long])


def test_fingerprint_is_the_definition(spark, rows):
    """Rebuild bins from each text's numbered runs, with Spark's hash as the only given."""
    texts = sorted({t or "" for _, t in rows})
    frame = spark.createDataFrame([(t,) for t in texts], "text string")
    got = {r.text: r.tokens for r in frame.select("text", om.tokens(F.col("text")).alias("tokens")).collect()}
    runs = {t: numbered_runs(t) for t in texts}
    every = sorted({(r, n) for t in texts for r, n in runs[t]})
    words = spark.createDataFrame([(list(r), n) for r, n in every], "r array<string>, n int")
    run = F.when(F.size("r") < om.K, F.xxhash64(F.array_join("r", " "))).otherwise(
        F.xxhash64(*[F.get("r", F.lit(k)) for k in range(om.K)]))
    hashes = words.select("r", "n", F.xxhash64(F.shiftright(run, 24), "n").alias("h")).collect()
    hashed = {(tuple(x.r), x.n): x.h >> 24 for x in hashes}
    pairs = set()
    chosen = {}
    for t in texts:
        bins = {}
        for at, run_ in enumerate(runs[t]):
            h = hashed[run_]
            bins.setdefault(h >> (40 - 6), []).append((h, at))
        chosen[t] = {}
        for b, entries in bins.items():
            least = sorted(entries)[:2]
            chosen[t][b] = tuple(h for h, _ in sorted(least, key=lambda e: e[1]))
            pairs.add(chosen[t][b])
    frame = spark.createDataFrame([(list(p),) for p in sorted(pairs)], "p array<bigint>")
    whole = F.when(F.size("p") == 1, F.xxhash64(F.get("p", F.lit(0)))).otherwise(
        F.xxhash64(F.get("p", F.lit(0)), F.get("p", F.lit(1))))
    pair_hash = {tuple(r.p): (r.h % 2**64) >> 40 for r in frame.select("p", whole.alias("h")).collect()}
    for t in texts:
        assert got[t] == sorted(((b + 32) << 24) | pair_hash[p] for b, p in chosen[t].items())


def test_order_matters(spark):
    w = [f"w{i}" for i in range(600)]
    moved = w[300:] + w[:300]
    frame = spark.createDataFrame([(" ".join(w), " ".join(moved))], "a string, b string")
    same = frame.select(om.likeness(om.tokens(F.col("a")), om.tokens(F.col("b"))).alias("s")).first().s
    assert same < 0.75  # nearly all runs are shared, but a pair keeps its order only within a half


def test_empty_table_and_single_row(spark):
    assert om.compare_with_edit(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    one = om.compare_with_edit(spark.createDataFrame([(4, "abcdefgh")], "doc_id long, text string")).first()
    assert one.edited_sha256 == hashlib.sha256(b"abcdefab").hexdigest()
