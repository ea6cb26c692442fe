"""Language identification with a byte convolutional network in numpy.

Windows of ``WINDOW`` bytes are embedded byte by byte, passed through filters of several
widths, pooled by their maximum and classified by a softmax. A text is cut into windows that
cover all of it; its log-probabilities are the mean over its windows by their length.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from planlens.llm import text as words
from planlens.llm.sampling import ids_per_label

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 12  # of each width
EMBEDDING = 8
PER_LABEL = 600  # labelled texts used for fitting, of each language
WINDOWS_PER_TEXT = 3
EPOCHS = 10
BATCH = 64
UNKNOWN = "und"
LEAST_SCORE = 0.35  # below, keep_known() rejects a text: hardly above chance among a few languages

_WIDEST = max(WIDTHS)
_ALL = FILTERS * len(WIDTHS)
# ASCII letters are lower-cased; a byte of 0 pads.
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def windows(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All windows of all texts, with the text and the number of bytes of each."""
    sizes = np.diff(offsets)
    counts = -(-sizes // WINDOW)
    starts = np.concatenate([[0], np.cumsum(counts)])
    flat = np.zeros(int(starts[-1]) * WINDOW, np.uint8)
    flat[np.arange(len(data)) + np.repeat(starts[:-1] * WINDOW - offsets[:-1], sizes)] = _LOWER[data]
    owner = np.repeat(np.arange(len(sizes)), counts)
    inside = np.arange(len(owner)) - starts[:-1][owner]
    return flat.reshape(-1, WINDOW), owner, np.minimum(WINDOW, sizes[owner] - inside * WINDOW)


@dataclass
class Network:
    labels: list[str]
    embedding: np.ndarray  # (256, EMBEDDING)
    filters: np.ndarray  # (_WIDEST * EMBEDDING, _ALL), rows beyond a filter's width are 0
    bias: np.ndarray
    dense: np.ndarray  # (_ALL, labels)
    dense_bias: np.ndarray

    def unfolded(self, batch: np.ndarray) -> np.ndarray:
        """The bytes before each position's widest filter, side by side."""
        e = self.embedding[batch]
        places = WINDOW - _WIDEST + 1
        return np.concatenate([e[:, k:k + places] for k in range(_WIDEST)], axis=2)

    def log_probabilities(self, batch: np.ndarray) -> np.ndarray:
        pooled = (self.unfolded(batch) @ self.filters).max(1) + self.bias
        z = np.maximum(pooled, 0) @ self.dense + self.dense_bias
        z -= z.max(1, keepdims=True)
        return z - np.log(np.exp(z).sum(1, keepdims=True))


def _mask() -> np.ndarray:
    mask = np.zeros((_WIDEST * EMBEDDING, _ALL), np.float32)
    for i, width in enumerate(WIDTHS):
        mask[:width * EMBEDDING, i * FILTERS:(i + 1) * FILTERS] = 1
    return mask


def fit(samples: np.ndarray, targets: np.ndarray, labels: list[str], epochs: int = EPOCHS) -> Network:
    """Adam on the cross-entropy of windows, every label weighing the same."""
    rng = np.random.default_rng(11)
    mask = _mask()
    net = Network(
        labels, rng.normal(0, 0.5, (256, EMBEDDING)).astype(np.float32),
        rng.normal(0, 0.25, mask.shape).astype(np.float32) * mask, np.zeros(_ALL, np.float32),
        rng.normal(0, 0.2, (_ALL, len(labels))).astype(np.float32), np.zeros(len(labels), np.float32),
    )
    net.embedding[0] = 0
    names = ("embedding", "filters", "bias", "dense", "dense_bias")
    first = {k: np.zeros_like(getattr(net, k)) for k in names}
    second = {k: np.zeros_like(getattr(net, k)) for k in names}
    counts = np.bincount(targets, minlength=len(labels))
    weight = (len(targets) / np.maximum(counts, 1) / len(labels)).astype(np.float32)
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(samples))
        for lo in range(0, len(order), BATCH):
            rows = order[lo:lo + BATCH]
            batch, target = samples[rows], targets[rows]
            unfolded = net.unfolded(batch)
            response = unfolded @ net.filters
            at = response.argmax(1)  # (rows, filters)
            pooled = np.take_along_axis(response, at[:, None, :], 1)[:, 0] + net.bias
            hidden = np.maximum(pooled, 0)
            z = hidden @ net.dense + net.dense_bias
            p = np.exp(z - z.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(rows)), target] -= 1
            p *= weight[target][:, None] / len(rows)
            back = (p @ net.dense.T) * (pooled > 0)
            seen = unfolded[np.arange(len(rows))[:, None], at]  # (rows, filters, widest * embedding)
            grad = {
                "dense": hidden.T @ p, "dense_bias": p.sum(0), "bias": back.sum(0),
                "filters": np.einsum("rf,rfk->kf", back, seen) * mask,
                "embedding": np.zeros_like(net.embedding),
            }
            parts = (back[:, :, None] * net.filters.T[None]).reshape(len(rows), _ALL, _WIDEST, EMBEDDING)
            for k in range(_WIDEST):
                used = np.take_along_axis(batch, at + k, 1)
                np.add.at(grad["embedding"], used, parts[:, :, k])
            grad["embedding"][0] = 0
            step += 1
            for k in names:
                first[k] = 0.9 * first[k] + 0.1 * grad[k]
                second[k] = 0.999 * second[k] + 0.001 * grad[k] ** 2
                change = (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
                setattr(net, k, (getattr(net, k) - 0.004 * change).astype(np.float32))
    return net


def learn(docs: DataFrame, labelled: DataFrame, *, per_label: int = PER_LABEL) -> Network | None:
    """A network from ``labelled`` (doc_id, label) and the texts of ``docs``.

    At most ``per_label`` texts of each language are used, and of each at most
    ``WINDOWS_PER_TEXT`` windows from places all over it. None without any labelled text.
    """
    words.small_batches(docs)
    chosen = ids_per_label(labelled, per_label)  # a bounded number of rows
    last = F.greatest(F.length("text") - WINDOW, F.lit(0))
    place = lambda k: F.pmod(F.xxhash64("doc_id", F.lit(k)), last + 1).cast("int") + 1
    cuts = F.array_distinct(F.array(*[
        F.substring(F.col("text"), place(k), F.lit(WINDOW)) for k in range(WINDOWS_PER_TEXT)
    ]))
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text")).where("text != ''")
    rows = (
        texts.join(F.broadcast(chosen), "doc_id")
        .select("label", F.explode(cuts).alias("text")).collect()
    )
    if not rows:
        return None
    rows.sort()
    labels = sorted({r.label for r in rows})
    data, offsets = words.buffers(pa.array([r.text for r in rows], pa.string()))
    samples, owner, _ = windows(data, offsets)
    index = {label: i for i, label in enumerate(labels)}
    return fit(samples, np.array([index[r.label] for r in rows])[owner], labels)


def predict(net: Network, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Probabilities per text and label; an empty text gets equal ones."""
    batch, owner, sizes = windows(data, offsets)
    total = np.zeros((len(offsets) - 1, len(net.labels)))
    for lo in range(0, len(batch), 128):
        here = slice(lo, lo + 128)
        np.add.at(total, owner[here], net.log_probabilities(batch[here]) * sizes[here, None])
    mean = total / np.maximum(np.diff(offsets), 1)[:, None]
    p = np.exp(mean - mean.max(1, keepdims=True))
    return p / p.sum(1, keepdims=True)


def _labeller(net: Network | None, position: int, letters: int, decide: bool):
    """Appends label and score, or keeps the rows of a known language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in words.pieces(batch, batch.schema.names[position], 1 << 20):
                known = part.column(letters).to_numpy(zero_copy_only=False).astype(bool)
                if net is None:
                    score, best = np.zeros(part.num_rows), [UNKNOWN] * part.num_rows
                    known[:] = False
                else:
                    p = predict(net, *words.buffers(part.column(position)))
                    score = np.where(known, p.max(1), 0.0)
                    best = [net.labels[i] if k else UNKNOWN for i, k in zip(p.argmax(1), known)]
                if decide:
                    whole = pa.RecordBatch.from_arrays(part.columns[:letters], part.schema.names[:letters])
                    yield whole.filter(pa.array(known & (score >= LEAST_SCORE)))
                else:
                    yield pa.RecordBatch.from_arrays(
                        [part.column(0), pa.array(best, pa.string()), pa.array(score)],
                        [part.schema.names[0], "lang_pred", "score"],
                    )

    return run


def has_letter(text) -> F.Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def identify(docs: DataFrame, net: Network | None) -> DataFrame:
    """(doc_id, lang_pred, score). Null texts and texts without a letter are ``und`` with a
    score of 0, as is everything when nothing was learnt."""
    words.small_batches(docs)
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    rows = rows.withColumn("letters", has_letter(F.col("text")))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(
        _labeller(net, 1, 2, False), f"doc_id {kind}, lang_pred string, score double"
    )


def keep_known(docs: DataFrame, net: Network | None) -> DataFrame:
    """The rows of ``docs``, all columns, whose language is known with ``LEAST_SCORE``."""
    words.small_batches(docs)
    rows = docs.select("*", has_letter(F.col("text").cast("string")))
    return rows.mapInArrow(
        _labeller(net, docs.columns.index("text"), len(docs.columns), True), docs.schema
    )
