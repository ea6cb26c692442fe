import hashlib

import numpy as np
import pytest

from planlens.llm import decontaminate as dc


def brute_force(text, items):
    w = dc.words(text)
    hit, found = set(), set()
    for item, body in items:
        b = dc.words(body)
        size = min(dc.WINDOW, len(b))
        for k in range(len(b) - size + 1) if b else ():
            for at in range(len(w) - size + 1):
                if w[at:at + size] == b[k:k + size]:
                    hit |= set(range(at, at + size))
                    found.add("" if item is None else str(item))
    return len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()


@pytest.fixture(scope="module")
def case():
    rng = np.random.default_rng(3)
    run = lambda n: " ".join(f"t{rng.integers(4)}" for _ in range(n))
    items = [(1, run(30)), (2, run(12)), (10, "Alpha, beta"), (11, "beta gamma delta"), (12, "..."),
             (13, None), (None, "solo one two"), (2, run(12))]
    docs = [(i, run(rng.integers(0, 80)) + " alpha BETA gamma " + run(20)) for i in range(30)]
    docs += [(30, items[0][1]), (31, None), (32, ""), (33, "Solo-one? two!"), (None, items[1][1] + " x"),
             (34, "x " * 20000 + items[0][1]), (34, "gamma"), (34, "gamma")]
    return docs, items


@pytest.mark.parametrize("shard_words", [10**6, 20])
def test_report_is_brute_force(spark, case, shard_words):
    docs, items = case
    found = dc.find_spans(
        spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, spans int"),
        spark.createDataFrame(items, "item_id long, text string"), shard_words=shard_words,
    )
    got = sorted((tuple(r)[:5] for r in dc.report(found).collect()), key=str)
    assert got == sorted(((i, *brute_force(t, items)) for i, t in docs), key=str)


def test_cleaning_leaves_no_window_and_no_clean_text_changed(spark, case):
    docs, items = case
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    before = {(i, t) for i, t in docs if not brute_force(t, items)[1]}
    after = [(r.doc_id, r.text) for r in dc.clean(frame, bench, max_coverage=1.0).collect()]
    assert before <= set(after)
    assert len(after) == len(docs)
    dropped = {i for i, t in docs if t and brute_force(t, items)[1] > 0.5 * len(dc.words(t))}
    assert {r.doc_id for r in dc.clean(frame, bench).collect()} == {i for i, _ in docs} - dropped


@pytest.mark.parametrize("max_coverage", [0.5, 1.0])
def test_cleaning_does_not_depend_on_the_shards(spark, case, max_coverage):
    docs, items = case
    parts = [" ".join(f"{c}{i}" for i in range(12)) for c in "ab"]
    items = [*items, (20, parts[0]), (21, parts[1])]
    half = f"{parts[0]} {' '.join(f'x{i}' for i in range(16))} {parts[1]}"  # 30 % and 30 % of 40 words
    overlap = [" ".join(f"o{i}" for i in range(a, a + 12)) for a in (0, 6)]
    items += [(22, overlap[0]), (23, overlap[1])]
    rows = [*docs, (40, half), (41, "y " * 40 + " ".join(f"o{i}" for i in range(18)))]
    frame = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, spans int")
    bench = spark.createDataFrame(items, "item_id long, text string")
    one, many = (
        sorted(map(tuple, dc.clean(frame, bench, max_coverage=max_coverage, shard_words=n).collect()), key=str)
        for n in (10**6, 20)
    )
    assert many == one
    assert (40 in {r[0] for r in many}) == (max_coverage == 1.0)


def test_cut_keeps_the_rest():
    text = "Keep this. One two, three! And that."
    assert dc.cut(text, [(2, 5)]) == "Keep this. ! And that."
    assert dc.cut(text, []) == text
    assert dc.cut("one two", [(0, 2)]) == ""


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    bench = spark.createDataFrame([], "item_id long, text string")
    assert dc.report(dc.find_spans(docs, bench)).collect() == []
    one = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    assert [tuple(r)[:3] for r in dc.report(dc.find_spans(one, bench)).collect()] == [(1, 2, 0)]
    assert dc.clean(one, bench).collect() == one.collect()
