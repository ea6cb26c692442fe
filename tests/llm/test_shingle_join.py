import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from planlens.llm import shingle_join as sj
from planlens.llm import text as words
from planlens.llm.decontaminate import words as word_list
from planlens.llm.shared_files import fetch, store


def shingles(text):
    w = word_list(text)
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute_force(rows):
    """{row number: (class id, links)} by comparing everything with everything."""
    sets = [shingles(t) for _, t in rows]
    texts = [t or "" for _, t in rows]
    near = defaultdict(set)
    for i in range(len(rows)):
        for j in range(i):
            union = len(sets[i] | sets[j])
            same = texts[i] == texts[j]
            if same or union and 5 * len(sets[i] & sets[j]) >= 4 * union:
                near[i].add(j)
                near[j].add(i)
    out, seen = {}, set()
    for i in range(len(rows)):
        if i in seen:
            continue
        group, todo = {i}, [i]
        while todo:
            for k in near[todo.pop()] - group:
                group.add(k)
                todo.append(k)
        seen |= group
        ids = [rows[k][0] for k in group if rows[k][0] is not None]
        for k in group:
            out[k] = (min(ids) if ids else None, len(near[k]))
    return out


def edited(base, changes, rng):
    w = base.split()
    for at in rng.choice(len(w), changes, replace=False):
        w[at] = f"new{rng.integers(10**6)}"
    return " ".join(w)


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(5)
    word = lambda: f"w{rng.integers(3000)}"
    out = []
    for _ in range(12):
        base = " ".join(word() for _ in range(rng.integers(60, 300)))
        out.append(base)
        out += [edited(base, c, rng) for c in (1, 2, 3, 4, 5, 8, 20)]
        out.append(base.upper().replace(" ", ", "))
    hot = " ".join(word() for _ in range(150))
    out += [edited(hot, 2, rng) for _ in range(40)]
    out += [hot] * 5 + ["", "", "...", None, "one two", "One two!", "eins", "a b c d e"]
    return [(i * 3 if i % 17 else None, t) for i, t in enumerate(out)]


def test_every_link_is_found(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    expected = brute_force(rows)
    wanted = sorted(((rows[k][0], *v) for k, v in expected.items()), key=str)
    got = sorted((tuple(r) for r in sj.link_counts(docs).collect()), key=str)
    assert got == wanted


def test_longer_first_prefixes_end_alike(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    short = sorted(map(str, sj.link_counts(docs).collect()))
    assert sorted(map(str, sj.link_counts(docs, first_depth=8).collect())) == short


def test_stripes_agree_with_whole_buckets(spark, rows, monkeypatch):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    whole = sorted(map(str, sj.link_counts(docs).collect()))
    monkeypatch.setattr(sj, "STRIPE", 4)
    assert sorted(map(str, sj.link_counts(docs).collect())) == whole


def test_links_within_a_group_of_3000_near_copies(spark):
    """Against counts of common shingles by hand; the group takes several stripes a tree."""
    rng = np.random.default_rng(8)
    base = " ".join(f"w{rng.integers(3000)}" for _ in range(80))
    rows = [(i, edited(base, int(rng.integers(0, 3)), rng)) for i in range(3000)]
    sets = [shingles(t) for _, t in rows]
    numbers = {s: k for k, s in enumerate(sorted(set().union(*sets)))}
    held = np.zeros((3000, len(numbers)), np.float32)
    for i, one in enumerate(sets):
        held[i, [numbers[s] for s in one]] = 1
    common, sizes = held @ held.T, held.sum(1)
    near = 5 * common >= 4 * (sizes[:, None] + sizes[None, :] - common)
    links, group = near.sum(1) - 1, np.arange(3000)
    while (low := np.where(near, group, 3000).min(1)).tolist() != group.tolist():
        group = low
    got = sj.link_counts(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    counted = np.array([r.n_links for r in sorted(got)])
    assert links.max() > sj.STRIPE
    assert [r.class_id for r in sorted(got)] == group.tolist()
    # A pair is missed once in 10,000 times at most.
    assert (counted <= links).all() and counted.sum() >= (1 - 1e-4) * links.sum()


def test_stored_stripes_come_back(tmp_path):
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, 500, k).astype(np.uint64)) for k in (0, 1, 90, 300)]
    one = sj.Stripe(
        np.array(["a" * 32, "b", "c", "d"], "S32"), np.arange(4), sj.labels(sets), sets, np.array([0, 0, 2, 2])
    )
    store(str(tmp_path), "x", one.pack())
    back = sj.Stripe.unpack(fetch(str(tmp_path), "x"))
    assert fetch(str(tmp_path), "y") is None
    for a, b in zip([one.keys, one.copies, one.marks, one.root, *one.sets],
                    [back.keys, back.copies, back.marks, back.root, *back.sets], strict=True):
        assert a.dtype == b.dtype and (a == b).all()
    plain = [[len(np.intersect1d(a, b)) for b in sets] for a in sets[:3]]
    assert (sj.overlaps(sets[:3], sets) == plain).all()
    off = ~np.eye(4, dtype=bool)
    assert (sj.overlaps(sets)[off] == sj.overlaps(sets, sets)[off]).all()


def test_one_of_each_group_stays_with_its_columns(spark, rows):
    docs = spark.createDataFrame(
        [(i, t, n, "x", n) for n, (i, t) in enumerate(rows)],
        "doc_id long, text string, key long, root string, _key long",
    )
    kept = sj.keep_one(docs)
    assert kept.columns == docs.columns
    assert all(r.key == r._key for r in kept.collect())
    groups = {v[0] for v in brute_force(rows).values() if v[0] is not None}
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == sorted(groups)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert sj.link_counts(docs).collect() == []
    assert sj.keep_one(docs).collect() == []


def test_words_and_shingles_match_the_pattern():
    rng = np.random.default_rng(1)
    letters = list("abzAZ09 .,;\n\té漢😀`{/:@[")
    texts = ["".join(rng.choice(letters, rng.integers(0, 60))) for _ in range(300)]
    texts += ["", "aB" * (words._PIECE // 2) + " tail", None]
    data, offsets = words.buffers(pa.array(texts))
    hashes, bounds = words.word_hashes(data, offsets)
    seen = {}
    for text, lo, hi in zip(texts, bounds[:-1], bounds[1:]):
        expected = word_list(text)
        assert hi - lo == len(expected)
        for word, h in zip(expected, hashes[lo:hi]):
            assert seen.setdefault(word, h) == h
    assert len(set(seen.values())) == len(seen)
    for text, found in zip(texts, words.shingle_sets(data, offsets)):
        assert len(found) == len(shingles(text))


def test_recall_is_that_of_the_least_similar_links():
    depth, target = sj.floor_depth(sj.TARGET_RECALL), sj.TARGET_RECALL
    bins = np.zeros(sj.BINS)
    assert sj.FIRST_DEPTH > depth and sj._recall(bins, sj.FIRST_DEPTH) < target
    bins[-1] = 10**6
    assert sj._recall(bins, sj.FIRST_DEPTH) >= target
    bins[int(0.8 * sj.BINS)] = 1
    assert sj._recall(bins, sj.FIRST_DEPTH) < target <= sj._recall(bins, depth)


def test_shortest_prefix_finds_pairs_at_the_threshold():
    for target in (0.95, 0.99, 0.9999):
        depth = sj.floor_depth(target)
        assert sj.found_chance(0.8, depth) >= target > sj.found_chance(0.8, depth + 1)
    with pytest.raises(ValueError, match=re.escape("can't find")):
        sj.floor_depth(1.0)
