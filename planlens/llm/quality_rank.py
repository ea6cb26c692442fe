"""Quality by Bradley-Terry pairwise ranking.

Each document has a score that is linear in features of its characters, words and lines.
Of a pair of a good and a bad document the good one wins with the logistic chance of
the difference of their scores; weights are learnt from preference pairs by that loss.
A second logistic fit, with the shares of all labelled rows, makes a score a probability. The
threshold is the quantile of all documents' scores at the share of bad rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from planlens.llm import text as words
from planlens.llm.sampling import ids_per_label
from planlens.session import settle

PER_LABEL = 3000  # labelled rows used for fitting, of each label
PAIRS = 30_000  # preference pairs drawn from them
STEPS = 400
PENALTY = 1e-3
DIGITS = 12  # of a score; a text's batch may change those beyond
CELLS = 4096  # of scores counted at a time

# Classes of bytes: white space, digits, letters, each ASCII sign by itself, bytes above 0x7F.
_CLASS = np.zeros(256, np.int64)
_CLASS[32], _CLASS[[9, 10, 11, 12, 13]] = 1, 2
_CLASS[48:58], _CLASS[65:91], _CLASS[97:123], _CLASS[128:] = 3, 4, 5, 6
_SIGNS = [b for b in range(33, 127) if not chr(b).isalnum()]
_CLASS[_SIGNS] = 7 + np.arange(len(_SIGNS))
_CLASSES = 7 + len(_SIGNS)
# For pairs of neighbours the signs fall into those of sentences and the others.
_COARSE = np.arange(_CLASSES)
_COARSE[7:] = 8
_COARSE[[_CLASS[ord(c)] for c in ".,;:?!'\"-()"]] = 7
_COARSES = 9
FEATURES = _CLASSES + _COARSES**2 + 5


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A row of ``FEATURES`` numbers per text; all but one of an empty text are 0."""
    n = len(offsets) - 1
    sizes = np.diff(offsets)
    owner = np.repeat(np.arange(n), sizes)
    kind = _CLASS[data]
    single = np.bincount(owner * _CLASSES + kind, minlength=n * _CLASSES).reshape(n, _CLASSES)
    coarse = _COARSE[kind]
    pairs = (owner[:-1] * _COARSES + coarse[:-1]) * _COARSES + coarse[1:]
    pairs = pairs[owner[:-1] == owner[1:]]
    double = np.bincount(pairs, minlength=n * _COARSES**2).reshape(n, _COARSES**2)
    hashes, bounds = words.word_hashes(data, offsets)
    counts = np.diff(bounds)
    distinct = np.array([len(np.unique(hashes[a:b])) for a, b in zip(bounds[:-1], bounds[1:])], float)
    lines = [data[a:b].tobytes().split(b"\n") for a, b in zip(offsets[:-1], offsets[1:])]
    repeated = [1 - len(set(x)) / len(x) for x in lines]
    length = np.maximum(sizes, 1)
    return np.column_stack([
        np.sqrt(single / length[:, None]), np.sqrt(double / length[:, None]),
        np.log1p(sizes), np.log1p(counts), distinct / np.maximum(counts, 1), repeated,
        sizes / np.maximum(counts, 1) / 10,
    ]).astype(np.float64)


@dataclass
class Ranking:
    """Weights over standardised features, and the logistic fit and threshold on top."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    slope: float
    offset: float
    threshold: float  # for the sample; keep_good() takes that of all its documents
    bad_share: float = 0.0  # of all labelled rows

    def strength(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -8, 8) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        """The chance of a good label, 0 to 1, rising with the ranking's strength."""
        return np.round(_sigmoid(self.slope * self.strength(x) + self.offset), DIGITS)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


def _descend(gradient, start: np.ndarray, steps: int, rate: float = 0.05) -> np.ndarray:
    """Adam steps along a gradient."""
    w, m, v = start.copy(), np.zeros_like(start), np.zeros_like(start)
    for t in range(1, steps + 1):
        g = gradient(w)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return w


def fit(x: np.ndarray, good: np.ndarray, good_share: float, pairs: int = PAIRS) -> Ranking:
    """From features and labels of the sample, and the share of good labels in all rows.

    Without rows of both labels nothing can be preferred: every score is the share.
    """
    if not len(x) or good.all() or not good.any():
        return Ranking(
            np.zeros(FEATURES), np.ones(FEATURES), np.zeros(FEATURES), 1.0,
            float(np.log((good_share + 1e-3) / (1 - good_share + 1e-3))), 0.0,
        )
    mean, scale = x.mean(0), x.std(0)
    scale[scale < 1e-6] = 1.0
    z = np.clip((x - mean) / scale, -8, 8)
    rng = np.random.default_rng(7)
    winners = rng.choice(np.flatnonzero(good), pairs)
    losers = rng.choice(np.flatnonzero(~good), pairs)
    block = 4096

    def gradient(w: np.ndarray) -> np.ndarray:
        total = np.zeros_like(w)
        s = z @ w
        lost = _sigmoid(s[losers] - s[winners])
        np_add = np.bincount(winners, lost, len(z)) - np.bincount(losers, lost, len(z))
        for a in range(0, len(z), block):
            total -= np_add[a:a + block] @ z[a:a + block]
        return total / pairs + PENALTY * w

    weights = _descend(gradient, np.zeros(z.shape[1]), STEPS)
    s = z @ weights
    share = np.where(good, good_share / good.mean(), (1 - good_share) / (1 - good.mean()))

    def calibration(w: np.ndarray) -> np.ndarray:
        error = (_sigmoid(w[0] * s + w[1]) - good) * share
        return np.array([(error * s).mean(), error.mean()])

    slope, offset = _descend(calibration, np.array([1.0, 0.0]), 2000)
    p = _sigmoid(max(slope, 1e-3) * s + offset)
    order = np.argsort(p)
    place = np.cumsum(share[order]) / share.sum()
    at = min(int(np.searchsorted(place, 1 - good_share + 1e-9, "right")), len(p) - 1)
    threshold = (p[order[at]] + p[order[max(at - 1, 0)]]) / 2
    return Ranking(
        mean, scale, weights, max(float(slope), 1e-3), float(offset), float(threshold), 1 - float(good_share)
    )


def _text_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in words.pieces(batch, "text", 1 << 20):
            x = features(*words.buffers(part.column("text")))
            rows = pa.array(list(x), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([part.column("good"), rows], ["good", "x"])


def learn(docs: DataFrame, labelled: DataFrame, *, per_label: int = PER_LABEL) -> Ranking:
    """A ranking from ``labelled`` (doc_id, label 0 or 1) and the texts of ``docs``.

    At most ``per_label`` rows of each label are used, the same on every run. Null labels,
    labels without a text and texts without a label are ignored.
    """
    words.small_batches(docs)
    shares = labelled.agg(F.avg(F.col("label").cast("double")).alias("good")).first()
    chosen = ids_per_label(labelled, per_label)  # a bounded number of rows
    texts = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    sample = texts.join(F.broadcast(chosen), "doc_id").select((F.col("label") == 1).alias("good"), "text")
    rows = sample.mapInArrow(_text_features, "good boolean, x array<double>").collect()
    rows.sort(key=lambda r: (r.good, r.x))
    x = np.array([r.x for r in rows]).reshape(-1, FEATURES)
    return fit(x, np.array([r.good for r in rows], bool), 0.5 if shares.good is None else shares.good)


def _scorer(ranking: Ranking, position: int, decide: bool):
    """Appends the score, or keeps the rows that reach the threshold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in words.pieces(batch, batch.schema.names[position], 1 << 20):
                p = ranking.score(features(*words.buffers(part.column(position))))
                if decide:
                    yield part.filter(pa.array(p >= ranking.threshold))
                else:
                    yield pa.RecordBatch.from_arrays(
                        [*part.columns, pa.array(p)], [*part.schema.names, "score"]
                    )

    return run


def score(docs: DataFrame, ranking: Ranking) -> DataFrame:
    """(doc_id, score). Null texts read as empty and get the empty text's score."""
    words.small_batches(docs)
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    scored = rows.mapInArrow(_scorer(ranking, 1, False), f"doc_id {kind}, text string, score double")
    return scored.select("doc_id", "score")


def quantile(scores: DataFrame, share: float) -> float:
    """The middle between the scores before and after the lowest ``share`` of all rows'.

    Exact: scores (0 to 1) are counted by cell, and those of the cell that holds the place by
    finer cells, until a cell is one score. The driver sees ``CELLS`` counts at a time.
    """

    def at(rank: int) -> float:
        low, width = 0.0, 1.0
        while True:
            here = scores.where((F.col("score") >= low) & (F.col("score") <= low + width))
            cell = F.least(F.floor((F.col("score") - low) / (width / CELLS)), F.lit(CELLS - 1))
            counted = here.groupBy(cell.alias("cell")).agg(
                F.count("*").alias("n"), F.min("score").alias("low"), F.max("score").alias("high")
            ).orderBy("cell").collect()
            below = scores.where(F.col("score") < low).count() if low > 0 else 0
            for r in counted:
                below += r.n
                if below > rank:
                    break
            if r.low == r.high:
                return r.low
            low, width = r.low, r.high - r.low

    n = scores.count()
    rejected = min(int(np.floor(share * n + 1e-9)), n - 1)
    if rejected <= 0:
        return 0.0
    return (at(rejected - 1) + at(rejected)) / 2


def keep_good(docs: DataFrame, ranking: Ranking) -> DataFrame:
    """The rows of ``docs``, all columns, whose score reaches the quantile of the scores of
    all ``docs`` at the share of bad labels."""
    ranking = replace(ranking, threshold=quantile(settle(score(docs, ranking).select("score")), ranking.bad_share))
    words.small_batches(docs)
    return docs.mapInArrow(_scorer(ranking, docs.columns.index("text"), True), docs.schema)
