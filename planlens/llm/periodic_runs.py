"""Periodic runs of words: stretches that repeat with a period of their own.

A run is a stretch of words whose smallest period is q, that has at least ``least_words``
words and ``exponent`` periods, and that no word beside it extends at that period.

Periods below ``DIRECT`` are found by comparing every word with the one q further on. For
longer ones a scale covers the periods from Q up to 1.5 Q. It hashes every stretch of
F = 1.5 Q - 1 words and keeps the *minimizers*: stretches whose hash is the least of some
window of w = 2 Q + 1 - F neighbours. Inside a run of period q the first window and the one q
later lie wholly in the run's three periods, hold the same stretches and so keep the same
minimum, q words apart. As F >= q, and the repeated word of a run is no power of a shorter
one, the same stretch occurs nowhere between the two: equal minimizers that follow each other
at a distance of Q to 1.5 Q are the seeds of all runs of that scale. There is at most one
seed per minimizer. Each is extended by comparing words, so hashes decide nothing.

All texts of a batch are one array, with a word of its own between two texts, so that short
texts share the work of an array operation.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from planlens.llm.text import mix, pieces, small_batches

LEAST_WORDS = 24
EXPONENT = 3
DIRECT = 16  # the first scale's least period

_ODD = np.uint64(0x9FB21C651E98DF25)
_BETWEEN = 1 << 40  # numbers of the words between texts; those of texts are smaller

RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"


def _joined(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """A hash of two neighbouring stretches from theirs. Not linear: there are texts for which
    a polynomial modulo 2**64 is no hash."""
    return mix(first * _ODD + second)


def _slide(take, values: np.ndarray, width: int) -> np.ndarray:
    """``take`` (minimum or maximum) of every ``width`` neighbours, by doubling."""
    out, size = values, 1
    while 2 * size <= width:
        out = take(out[:-size], out[size:])
        size *= 2
    rest = width - size
    return take(out[:-rest], out[rest:]) if rest else out


def minimizers(values: np.ndarray, width: int) -> np.ndarray:
    """Places whose value is the least of some window of ``width`` values, ties included."""
    if len(values) < width:
        return np.zeros(0, np.int64)
    edge = np.zeros(width - 1, values.dtype)
    lows = np.concatenate([edge, _slide(np.minimum, values, width), edge])
    return np.flatnonzero(_slide(np.maximum, lows, width) == values)


def _first(hits: np.ndarray) -> int:
    """The place of the first true value, or the length."""
    at = int(hits.argmax()) if len(hits) else 0
    return at if len(hits) and hits[at] else len(hits)


def _stretch(x: np.ndarray, at: int, lag: int) -> tuple[int, int]:
    """The longest stretch of places around ``at`` that equal the place ``lag`` further on,
    compared in blocks of doubling size."""
    hi, last, size = at, len(x) - lag, 64
    while hi < last:
        end = min(hi + size, last)
        same = _first(x[hi:end] != x[hi + lag:end + lag])
        hi += same
        if hi < end:
            break
        size *= 2
    lo, size = at, 64
    while lo > 0:
        begin = max(0, lo - size)
        same = _first((x[begin:lo] != x[begin + lag:lo + lag])[::-1])
        lo -= same
        if lo > begin:
            break
        size *= 2
    return lo, hi


def _direct(x: np.ndarray, lag: int, least: int) -> Iterator[tuple[int, int]]:
    """(start, past the end) of stretches of at least ``least`` words with period ``lag``."""
    odd = np.concatenate([[-1], np.flatnonzero(x[:-lag] != x[lag:]), [len(x) - lag]])
    for k in np.flatnonzero(np.diff(odd) - 1 + lag >= least):
        yield int(odd[k]) + 1, int(odd[k + 1]) + lag


def _seeds(values: np.ndarray, width: int, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and distances of equal minimizers that follow each other ``low`` to ``high``
    (not reached) apart, by distance and place."""
    places = minimizers(values, width)
    places = places[np.argsort(values[places], kind="stable")]
    apart = np.diff(places)
    hit = (values[places[1:]] == values[places[:-1]]) & (apart >= low) & (apart < high)
    at, lag = places[:-1][hit], apart[hit]
    order = np.lexsort((at, lag))
    return at[order], lag[order]


def _find(x: np.ndarray, ends: np.ndarray, least_words: int, exponent: int) -> list[tuple[int, int, int]]:
    """(start, past the end, period) of the runs in ``x``; ``ends`` are those of its texts, the
    shortest text first."""
    best: dict[tuple[int, int], int] = {}

    def add(start: int, past: int, period: int) -> None:
        # The same stretch at a multiple of its smallest period is the same run.
        if past - start >= max(least_words, exponent * period):
            best[start, past] = min(period, best.get((start, past), period))

    sizes = np.diff(ends, prepend=0) - 1  # without the word between two texts

    def from_size(least: int) -> int:
        """Where the texts of at least ``least`` words begin."""
        k = int(np.searchsorted(sizes, least))
        return int(ends[k - 1]) if k else 0

    for lag in range(1, DIRECT):
        least = max(least_words, exponent * lag)
        skipped = from_size(least)
        if len(x) - skipped > lag:
            for start, past in _direct(x[skipped:], lag, least):
                add(start + skipped, past + skipped, lag)

    low, span = DIRECT, 1
    begin, hashes = 0, mix(x.astype(np.uint64) + np.uint64(1))  # of stretches of ``span`` words
    while True:
        high = low * 3 // 2
        size, skipped = high - 1, from_size(max(least_words, exponent * low))
        if skipped >= len(x):
            break
        hashes, begin = hashes[skipped - begin:], skipped
        while 2 * span <= size:
            hashes = _joined(hashes[:-span], hashes[span:])
            span *= 2
        n = len(x) - begin - size + 1
        rest = size - span
        values = _joined(hashes[:n], hashes[rest:rest + n])
        places, lags = _seeds(values, 2 * low + 1 - size, low, high)
        at = 0
        while at < len(places):
            place, lag = int(places[at]), int(lags[at])
            lo, hi = _stretch(x, begin + place, lag)
            add(lo, hi + lag, lag)
            same = int(np.searchsorted(lags, lag, "right"))
            at += max(1, int(np.searchsorted(places[at:same], hi - begin)))
        low = high
    return [(start, past, period) for (start, past), period in best.items()]


def runs_of(
    texts: list[np.ndarray], least_words: int = LEAST_WORDS, exponent: int = EXPONENT
) -> list[list[tuple[int, int, int]]]:
    """(start, length, period) of each text's runs, by start and period.

    A text is an array of word numbers (at least 0, below 2**40): equal words, equal numbers.
    """
    if exponent < 3:
        raise ValueError("a scale finds runs of three periods or more")
    order = sorted(range(len(texts)), key=lambda k: len(texts[k]))
    parts = []
    for nth, k in enumerate(order):
        parts += [texts[k], np.array([_BETWEEN + nth])]
    x = np.concatenate(parts).astype(np.int64) if parts else np.zeros(0, np.int64)
    ends = np.cumsum([len(texts[k]) + 1 for k in order])
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for start, past, period in _find(x, ends, least_words, exponent) if len(x) else ():
        nth = int(np.searchsorted(ends, start, "right"))
        begin = int(ends[nth - 1]) if nth else 0
        found[order[nth]].append((start - begin, past - start, period))
    return [sorted(f, key=lambda r: (r[0], r[2])) for f in found]


def kept_words(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Which of ``n`` words stay if each run is cut to its first period; a word that any run
    drops goes."""
    edge = np.zeros(n + 1, np.int64)
    for start, length, period in runs:
        edge[start + period] += 1
        edge[start + length] -= 1
    return np.cumsum(edge[:n]) == 0


def find_runs(
    docs: DataFrame, *, least_words: int = LEAST_WORDS, exponent: int = EXPONENT
) -> DataFrame:
    """(doc_id, n_words, runs, collapsed) of each row of ``docs`` (doc_id, text).

    Words are split at ASCII white space. ``runs`` are (start, length, period) in words, by
    start and period; ``collapsed`` is the text with each run cut to its first period, its
    words joined by one space.

    Null and empty texts have no words, no runs and the empty text. Repeated rows each have
    their row, an empty table none; further columns are left out, whatever their names. Nothing
    is shuffled. A task holds about a megabyte of texts, or one longer text, as about 100
    bytes a word.
    """
    small_batches(docs)
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    run_type = pa.list_(pa.struct([(k, pa.int64()) for k in ("start", "length", "period")]))

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text"):
                numbers: dict[bytes, int] = {}
                texts = []
                for text in part.column("text").cast(pa.binary()):
                    words = (text.as_py() or b"").split()
                    texts.append(np.fromiter(
                        (numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words)
                    ))
                names = list(numbers)
                found = runs_of(texts, least_words, exponent)
                collapsed = []
                for numbered, runs in zip(texts, found):
                    kept = numbered[kept_words(len(numbered), runs)] if runs else numbered
                    collapsed.append(b" ".join([names[k] for k in kept.tolist()]).decode())
                as_dicts = [
                    [{"start": s, "length": n, "period": p} for s, n, p in runs] for runs in found
                ]
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id"), pa.array([len(t) for t in texts], pa.int64()),
                    pa.array(as_dicts, run_type), pa.array(collapsed, pa.string()),
                ], ["doc_id", "n_words", "runs", "collapsed"])

    return rows.mapInArrow(over, f"doc_id {kind}, n_words bigint, runs {RUNS}, collapsed string")


def strongest(runs: F.Column) -> F.Column:
    """Of runs by start and period, the first with the greatest length / period, compared
    exactly; null if there is none."""
    none = F.lit(None).cast(RUNS[6:-1])
    return F.aggregate(runs, none, lambda best, run: F.when(
        best.isNull() | (run["length"] * best["period"] > best["length"] * run["period"]), run
    ).otherwise(best))
