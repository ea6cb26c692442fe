import hashlib
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from planlens.llm import periodic_runs as pr
from planlens.llm.queries import op11_periodic_runs


def brute_force(x, least_words=24, exponent=3):
    """Every lag, every stretch, every smaller period."""
    n, found = len(x), set()
    for lag in range(1, n // exponent + 1):
        at = 0
        while at < n - lag:
            end = at
            while end < n - lag and x[end] == x[end + lag]:
                end += 1
            if end > at and end + lag - at >= max(least_words, exponent * lag):
                s, e = at, end + lag
                if not any(all(x[k] == x[k + p] for k in range(s, e - p)) for p in range(1, lag)):
                    found.add((s, e - s, lag))
            at = max(end, at + 1)
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapse(words, runs):
    gone = {k for s, n, p in runs for k in range(s + p, s + n)}
    return [w for k, w in enumerate(words) if k not in gone]


part = st.one_of(
    st.lists(st.integers(0, 2), max_size=30),
    st.tuples(st.lists(st.integers(0, 2), min_size=1, max_size=60), st.integers(1, 5), st.integers(0, 9)).map(
        lambda t: (t[0] * t[1] + t[0][:t[2]])
    ),
)
text = st.lists(part, max_size=3).map(lambda ps: [w for p in ps for w in p])


@settings(max_examples=150, deadline=None)
@given(st.lists(text, max_size=5))
def test_runs_are_brute_force(texts):
    got = pr.runs_of([np.array(t, np.int64) for t in texts])
    assert got == [brute_force(t) for t in texts]
    for t, runs in zip(texts, got):
        assert np.array(t)[pr.kept_words(len(t), runs)].tolist() == collapse(t, runs) if t else not runs


@pytest.mark.parametrize("period", [15, 16, 23, 24, 35, 36, 80, 81, 120, 121, 500, 4001])
def test_every_scale_finds_three_periods_and_not_less(period):
    rng = np.random.default_rng(period)
    unit = rng.integers(0, 1000, period)
    three = np.tile(unit, 3)
    around = lambda x: np.concatenate([[5000, 5001], x, [5002]])
    size = max(24, 3 * period)
    assert pr.runs_of([around(three)]) == [[(2, size, period)]]
    assert pr.runs_of([around(three[:-1])]) == [[]]


def test_words_of_two_letters_that_defeat_polynomial_hashes():
    thue_morse = np.array([bin(k).count("1") % 2 for k in range(4096)])
    found = pr.runs_of([np.concatenate([[5], np.tile(thue_morse, 3), [7]])])[0]
    assert [r for r in found if r[2] > 1000] == [(1, 3 * 4096, 4096)]


def test_other_least_words_and_exponents():
    x = [0, 1] * 4 + [2]
    assert pr.runs_of([np.array(x)], least_words=8) == [[(0, 8, 2)]]
    assert pr.runs_of([np.array(x)], least_words=6, exponent=5) == [[]]
    with pytest.raises(ValueError):
        pr.runs_of([np.array(x)], exponent=2)


def test_find_runs_on_odd_rows(spark):
    cycle = "a b c " * 10
    rows = [(1, None), (2, ""), (3, " \t\n "), (4, cycle), (4, cycle), (None, "x " * 24),
            (5, "z" * 1_000_000), (6, "long é  text\x0bmore " * 40_000), (7, "no run " + " ".join(map(str, range(99))))]
    frame = spark.createDataFrame([(*r, 1, "k") for r in rows], "doc_id long, text string, runs int, n_words string")
    got = sorted(((r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in pr.find_runs(frame).collect()), key=str)
    assert got == sorted([
        (1, 0, [], ""), (2, 0, [], ""), (3, 0, [], ""),
        (4, 30, [(0, 30, 3)], "a b c"), (4, 30, [(0, 30, 3)], "a b c"),
        (None, 24, [(0, 24, 1)], "x"), (5, 1, [], "z" * 1_000_000),
        (6, 160_000, [(0, 160_000, 4)], "long é  text more"),
        (7, 101, [], "no run " + " ".join(map(str, range(99)))),
    ], key=str)
    assert pr.find_runs(frame.limit(0)).collect() == []
    named = spark.createDataFrame([("a", "x " * 30)], "doc_id string, text string")
    assert pr.find_runs(named).first().doc_id == "a"


def test_query_is_brute_force(spark, tmp_path):
    rng = np.random.default_rng(4)
    body = lambda n, k: " ".join(f"w{rng.integers(k)}" for _ in range(n))
    rows = [(i, body(int(rng.integers(0, 260)), int(rng.integers(1, 40)))) for i in range(160)]
    rows += [(160, None), (161, ""), (162, " \n"), (3, "again " * 30), (None, "q r " * 40)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    expected = []
    for i, t in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        h, n = zlib.crc32(("" if i is None else str(i)).encode()), len(words)
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if k < a else words[a + (k - a) % p] for k, w in enumerate(words)]
        runs = brute_force(words)
        best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        expected.append((
            i, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
            sha("".join(f"{s},{m},{p}\n" for s, m, p in runs)), sha(" ".join(collapse(words, runs))),
        ))
    names = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    got = [tuple(r) for r in op11_periodic_runs(spark, str(tmp_path)).select(*names).collect()]
    assert sorted(got, key=str) == sorted(expected, key=str)
    assert sum(e[1] for e in expected) > 10
