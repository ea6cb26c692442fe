"""Toxicity by nearest labelled examples under exact TF-IDF cosine.

Every word of an example is a term. Its weight is that of TF-IDF, with document frequencies of
all documents, times a gain that is above 1 where labelled texts with the word are toxic above
all; so the neighbours of a text are those that share such words, then those on its subject.
The labelled examples are held in a block-max inverted index: postings by word and block of
examples, with the largest weight of each word in each block. Frequent words are full rows, which
many queries meet in one product of matrices. A query visits the blocks whose upper bound
reaches what those words alone give its k-th neighbour, so the neighbours are exact. They
vote by closeness, and a logistic fit of the examples' own left-out votes calibrates the score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from planlens.llm import text as words
from planlens.llm.sampling import ids_per_label
from planlens.session import settle

PER_LABEL = 2000  # labelled examples in the index, of each label
LEAST_RATIO = 6.63  # likelihood ratio of a word in the examples, for a gain: 99 of 100
SURE = 2.33  # standard errors of the share of toxic texts that count against a gain: 99 of 100
GAIN = 12.0  # added to the factor 1 of a word whose texts are all toxic
NEIGHBOURS = 25
BLOCK = 64  # examples
DENSE = 32  # a word of at least one example in so many is held as a full row
TOGETHER = 64  # texts whose frequent words are multiplied with those rows at a time
SOFTNESS = 0.05  # added to a distance before it is inverted


class Vocabulary:
    """Words by their hash, with inverse document frequencies."""

    def __init__(self, hashes: np.ndarray, idf: np.ndarray) -> None:
        order = np.argsort(hashes)
        self.hashes, self.idf = hashes[order], idf[order]

    def occurrences(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, term, count) of the terms that occur, sorted by text and term."""
        found, bounds = words.word_hashes(data, offsets)
        m = len(self.hashes)
        if not m or not len(found):
            none = np.zeros(0, np.int64)
            return none, none, none
        at = np.minimum(np.searchsorted(self.hashes, found), m - 1)
        hit = np.flatnonzero(self.hashes[at] == found)
        owner = np.searchsorted(bounds, hit, "right") - 1
        cells, counts = np.unique(owner * m + at[hit], return_counts=True)
        return cells // m, cells % m, counts

    def vectors(self, data: np.ndarray, offsets: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """(terms, weights) of each text, of length 1 or empty."""
        owner, term, count = self.occurrences(data, offsets)
        weight = (1 + np.log(count)) * self.idf[term]
        bounds = np.searchsorted(owner, np.arange(len(offsets)))
        out = []
        for a, b in zip(bounds[:-1], bounds[1:]):
            w = weight[a:b]
            out.append((term[a:b], w / np.sqrt((w * w).sum()) if b > a else w))
        return out


class BlockMaxIndex:
    """Postings of examples by term and block, with each block's largest weight per term.

    Flat arrays: a term has a run of cells, one per block, and a cell a run of postings. Terms
    of at least one example in ``DENSE`` have a full row of weights by block instead of postings.
    """

    def __init__(self, vectors: list[tuple[np.ndarray, np.ndarray]], terms: int) -> None:
        # Examples with the same leading term stand together, which sharpens the bounds.
        lead = [(int(t[w.argmax()]), -float(w.max())) if len(t) else (terms, 0.0) for t, w in vectors]
        self.order = np.array(sorted(range(len(vectors)), key=lambda i: (lead[i], i)), np.int64)
        self.spot = np.argsort(self.order)
        self.blocks = -(-len(vectors) // BLOCK)
        sizes = [len(vectors[i][0]) for i in self.order]
        place = np.repeat(np.arange(len(vectors)), sizes).astype(np.int32)
        none = np.zeros(0)
        term = np.concatenate([none, *(vectors[i][0] for i in self.order)]).astype(np.int64)
        weight = np.concatenate([none, *(vectors[i][1] for i in self.order)])
        by = np.lexsort((place, term))
        self.place, self.weight = place[by], weight[by]
        often = np.bincount(term, minlength=terms) * DENSE >= len(vectors)
        self.row = np.where(often, np.cumsum(often) - 1, -1)
        full = often[term[by]]
        self.rows = np.zeros((int(often.sum()), self.blocks * BLOCK))
        self.rows[self.row[term[by][full]], self.place[full]] = self.weight[full]
        cell, first = np.unique(term[by] * max(self.blocks, 1) + self.place // BLOCK, return_index=True)
        self.block = (cell % max(self.blocks, 1)).astype(np.int32)
        self.posting = np.append(first, len(by))
        self.most = np.maximum.reduceat(self.weight, first) if len(first) else none
        self.cell = np.searchsorted(cell // max(self.blocks, 1), np.arange(terms + 1))

    def __getstate__(self) -> dict:
        return {name: value for name, value in vars(self).items() if name != "_single"}

    @cached_property
    def _single(self) -> np.ndarray:
        return self.rows.astype(np.float32)

    def frequent(self, vectors: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[np.ndarray]:
        """For each vector, the part of its cosines that frequent terms bring, in single precision:
        one product of matrices for ``TOGETHER`` vectors."""
        for start in range(0, len(vectors), TOGETHER):
            some = vectors[start:start + TOGETHER]
            asked = np.zeros((len(some), len(self.rows)), np.float32)
            for shares, (terms, weights) in zip(asked, some):
                row = self.row[terms]
                shares[row[row >= 0]] = weights[row >= 0]
            yield from asked @ self._single

    def nearest(
        self, terms: np.ndarray, weights: np.ndarray, k: int, skip: int = -1,
        frequent: np.ndarray | None = None,
    ) -> tuple[np.ndarray, np.ndarray, int]:
        """The ``k`` nearest examples with a common term, their cosines, and blocks visited.

        Nearest first, ties by example number. ``skip`` is left out. ``frequent`` is the vector's
        share of the method of that name. It alone bounds the k-th cosine from below, and with
        the blocks' largest weights of the other terms each block's from above. What the blocks
        that may reach it hold is summed; examples within the error of single precision of the
        k-th are compared by their cosines in double precision.
        """
        if frequent is None:
            frequent = next(self.frequent([(terms, weights)]))
        row = self.row[terms]
        often = row >= 0
        row, share, terms, weights = row[often], weights[often], terms[~often], weights[~often]
        slack = (len(row) + 8) * 2.0**-24 + 1e-9
        cosine = frequent.astype(float)
        if skip >= 0:
            cosine[self.spot[skip]] = 0
        cells, owner = _runs(self.cell[terms], self.cell[terms + 1])
        block, factor = self.block[cells], weights[owner]
        bound = np.bincount(block, factor * self.most[cells], self.blocks)
        bound = bound + cosine.reshape(self.blocks, BLOCK).max(1)
        asked = (bound > 0) & (bound >= _largest(cosine, k) - 2 * slack)
        some = asked[block]
        at, which = _runs(self.posting[cells[some]], self.posting[cells[some] + 1])
        rest = np.bincount(self.place[at], self.weight[at] * factor[some][which], len(cosine))
        cosine = cosine + rest
        if skip >= 0:
            cosine[self.spot[skip]] = 0
        hit = np.flatnonzero((cosine > 0) & (cosine >= _largest(cosine, k) - 2 * slack))
        # Summed term by term, so that a cosine depends on nothing but the two texts.
        each = self.rows[row[:, None], hit] * share[:, None]
        exact = np.bincount(np.tile(np.arange(len(hit)), len(row)), each.ravel(), len(hit))
        exact = np.round(exact + rest[hit], 12)
        example = self.order[hit]
        best = np.lexsort((example, -exact))[:k]
        return example[best], exact[best], int(asked.sum())


def _largest(values: np.ndarray, k: int) -> float:
    """The k-th largest of them, 0 if they are fewer."""
    return float(np.partition(values, -k)[-k]) if len(values) >= k else 0.0


def _runs(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of the ranges, one range after the other, and the range of each."""
    sizes = ends - starts
    owner = np.repeat(np.arange(len(starts)), sizes)
    return np.arange(len(owner)) + np.repeat(starts - np.cumsum(sizes) + sizes, sizes), owner


@dataclass
class Neighbourhood:
    """The index with the labels, ids and weights of its examples, and the calibration."""

    vocabulary: Vocabulary
    index: BlockMaxIndex
    toxic: np.ndarray
    ids: list
    share: np.ndarray  # of each example, so that labels weigh as in all labelled rows
    prior: float  # toxic share of all labelled rows
    blank: float  # toxic share of examples without any term of the vocabulary
    slope: float = 1.0
    offset: float = 0.0

    def votes(
        self, vectors: list[tuple[np.ndarray, np.ndarray]], left_out: bool = False
    ) -> Iterator[tuple[float, np.ndarray, np.ndarray]]:
        """Vote, nearest examples and their cosines of each vector; ``left_out`` if these are the
        examples themselves, each of which is then left out of its own neighbours."""
        # One voice of the prior at a right angle keeps single neighbours from certainty.
        rest = 1 / (1 + SOFTNESS)
        for i, ((terms, weights), part) in enumerate(zip(vectors, self.index.frequent(vectors))):
            found, cosine, _ = self.index.nearest(
                terms, weights, NEIGHBOURS, i if left_out else -1, part
            ) if len(terms) else (np.zeros(0, np.int64), np.zeros(0), 0)
            if not len(found):
                yield self.blank, found, cosine
                continue
            voice = self.share[found] / (1 - np.minimum(cosine, 1) + SOFTNESS)
            vote = (voice @ self.toxic[found] + rest * self.prior) / (voice.sum() + rest)
            yield float(vote), found, cosine

    def calibrated(self, vote: np.ndarray | float) -> np.ndarray | float:
        v = np.clip(vote, 1e-4, 1 - 1e-4)
        return 1 / (1 + np.exp(-(self.slope * np.log(v / (1 - v)) + self.offset)))


def build(
    vocabulary: Vocabulary, vectors: list, toxic: np.ndarray, ids: list, prior: float
) -> Neighbourhood:
    toxic = toxic.astype(float)
    rate = toxic.mean() if len(toxic) else prior
    share = np.where(toxic > 0, prior / max(rate, 1e-9), (1 - prior) / max(1 - rate, 1e-9))
    empty = np.array([not len(t) for t, _ in vectors], bool)
    held = share[empty].sum()
    blank = float((share[empty] @ toxic[empty] + prior) / (held + 1)) if len(toxic) else prior
    near = Neighbourhood(
        vocabulary, BlockMaxIndex(vectors, len(vocabulary.hashes)), toxic, ids, share, prior, blank
    )
    if 0 < rate < 1:
        votes = np.array([vote for vote, _, _ in near.votes(vectors, left_out=True)])
        z = np.log(np.clip(votes, 1e-4, 1 - 1e-4) / (1 - np.clip(votes, 1e-4, 1 - 1e-4)))
        a, b = 1.0, 0.0
        for _ in range(50):  # Newton steps with a ridge towards the plain vote
            p = 1 / (1 + np.exp(-(a * z + b)))
            error, curve = share * (p - toxic), share * p * (1 - p)
            g = np.array([error @ z + (a - 1), error.sum() + b])
            h = np.array([[curve @ (z * z) + 1, curve @ z], [curve @ z, curve.sum() + 1]])
            step = np.linalg.solve(h, g)
            a, b = a - step[0], b - step[1]
            if np.abs(step).max() < 1e-9:
                break
        near.slope, near.offset = float(max(a, 1e-3)), float(b)
    return near


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct word hashes of each text, and how often each occurs."""
    for batch in batches:
        for part in words.pieces(batch, "text", 1 << 20):
            found, bounds = words.word_hashes(*words.buffers(part.column("text")))
            each = [np.unique(found[a:b], return_counts=True) for a, b in zip(bounds[:-1], bounds[1:])]
            yield pa.RecordBatch.from_arrays([
                part.column("doc_id"), part.column("label"),
                pa.array([h.view(np.int64) for h, _ in each], pa.list_(pa.int64())),
                pa.array([n for _, n in each], pa.list_(pa.int64())),
            ], ["doc_id", "label", "hashes", "counts"])


def _occurring(vocabulary: Vocabulary, candidate: np.ndarray, id_type: pa.DataType):
    """(doc_id, terms) of the texts that have some candidate, and (term, n) of all terms, once
    per task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(len(candidate), np.int64)
        names = ["doc_id", "terms", "term", "n"]
        for batch in batches:
            for part in words.pieces(batch, "text", 1 << 20):
                owner, term, _ = vocabulary.occurrences(*words.buffers(part.column("text")))
                seen += np.bincount(term, minlength=len(seen))
                owner, term = owner[candidate[term]], term[candidate[term]]
                rows, starts = np.unique(owner, return_index=True)
                bounds = pa.array(np.append(starts, len(term)).astype(np.int32))
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id").take(pa.array(rows)),
                    pa.ListArray.from_arrays(bounds, pa.array(term.astype(np.int32))),
                    pa.nulls(len(rows), pa.int32()), pa.nulls(len(rows), pa.int64()),
                ], names)
        some = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([
            pa.nulls(len(some), id_type), pa.nulls(len(some), pa.list_(pa.int32())),
            pa.array(some.astype(np.int32)), pa.array(seen[some]),
        ], names)

    return run


def _by_label(terms: int):
    """(term, toxic, other): texts of either kind that have a term, once per task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros((2, terms), np.int64)
        for batch in batches:
            kind = (batch.column("label").to_numpy(zero_copy_only=False) != 1).astype(np.int64)
            held = batch.column("terms")
            sizes = held.value_lengths().to_numpy(zero_copy_only=False)
            flat = held.flatten().to_numpy(zero_copy_only=False)
            cells = np.repeat(kind, sizes) * terms + flat
            seen += np.bincount(cells, minlength=2 * terms).reshape(2, terms)
        some = np.flatnonzero(seen.any(0))
        yield pa.RecordBatch.from_arrays(
            [pa.array(some.astype(np.int32)), pa.array(seen[0, some]), pa.array(seen[1, some])],
            ["term", "toxic", "other"],
        )

    return run


def _lists(column: pa.ChunkedArray) -> list[np.ndarray]:
    """The lists of a column as slices of one array."""
    ends = np.cumsum([0, *pc.list_value_length(column).to_pylist()])
    flat = pc.list_flatten(column).to_numpy()
    return [flat[a:b] for a, b in zip(ends[:-1], ends[1:])]


def likelihood_ratio(a: np.ndarray, c: np.ndarray, toxic: int, other: int) -> np.ndarray:
    """Of words in ``a`` of the toxic and ``c`` of the other texts."""
    either = (a + c) / (toxic + other)
    cells = [(a, either * toxic), (toxic - a, (1 - either) * toxic),
             (c, either * other), (other - c, (1 - either) * other)]
    with np.errstate(divide="ignore", invalid="ignore"):
        return 2 * sum(np.where(seen > 0, seen * np.log(seen / expected), 0) for seen, expected in cells)


def _gains(toxic: np.ndarray, other: np.ndarray, prior: float) -> np.ndarray:
    """1, and more by how far Wilson's lower bound of a word's toxic share is above ``prior``."""
    n = np.maximum(toxic + other, 1)
    share = toxic / n
    spread = SURE * np.sqrt(share * (1 - share) / n + SURE**2 / (4 * n**2))
    low = (share + SURE**2 / (2 * n) - spread) / (1 + SURE**2 / n)
    return 1 + GAIN * np.clip((low - prior) / max(1 - prior, 1e-9), 0, 1)


def learn(docs: DataFrame, labelled: DataFrame, *, per_label: int = PER_LABEL) -> Neighbourhood:
    """The index of ``labelled`` (doc_id, label 0 or 1) examples among ``docs``.

    At most ``per_label`` examples of each label are held, the same on every run; document
    frequencies are of all ``docs``, and gains of all labelled texts. Words that are
    significantly more frequent in toxic examples can have a gain; no word is left out. Null
    labels, and labels without a text, are ignored. Without labels every score is one half.
    """
    words.small_batches(docs)
    share = labelled.agg(F.avg(F.col("label").cast("double")).alias("toxic")).first().toxic
    prior = 0.5 if share is None else float(share)
    one = F.col("label").cast("int").alias("label")
    chosen = ids_per_label(labelled.select("doc_id", one), per_label)
    texts = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    id_type = texts.schema["doc_id"].dataType
    kind = id_type.simpleString()
    sample = texts.join(F.broadcast(chosen), "doc_id").select("doc_id", "label", "text")
    rows = sample.mapInArrow(
        _word_counts, f"doc_id {kind}, label int, hashes array<long>, counts array<long>"
    ).toArrow()  # at most per_label texts of each label
    ids, hashes, counts = rows["doc_id"].to_pylist(), _lists(rows["hashes"]), _lists(rows["counts"])
    order = sorted(range(len(ids)), key=lambda i: (ids[i], hashes[i].tobytes()))
    ids, counts = [ids[i] for i in order], [counts[i] for i in order]
    hashes = [hashes[i].view(np.uint64) for i in order]
    toxic = rows["label"].to_numpy()[np.array(order, np.int64)] == 1
    every = np.unique(np.concatenate([np.zeros(0, np.uint64), *hashes]))
    terms = [np.searchsorted(every, h) for h in hashes]
    held = [np.concatenate([np.zeros(0, np.int64), *(t for t, x in zip(terms, toxic) if x == side)])
            for side in (True, False)]
    a, c = (np.bincount(t, minlength=len(every)) for t in held)
    n_toxic, n_other = int(toxic.sum()), int((~toxic).sum())
    candidate = np.zeros(len(every), bool)
    if n_toxic and n_other:
        candidate = (a * n_other > c * n_toxic) & (likelihood_ratio(a, c, n_toxic, n_other) >= LEAST_RATIO)

    plain = Vocabulary(every, np.ones(len(every)))
    found = settle(texts.mapInArrow(
        _occurring(plain, candidate, to_arrow_type(id_type)),
        f"doc_id {kind}, terms array<int>, term int, n long",
    ))
    frequency, gain = np.zeros(len(every)), np.ones(len(every))
    # As many rows as the examples have words, here and below.
    seen = found.where("term is not null").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    frequency[seen["term"].to_numpy()] = seen["n"].to_numpy()
    label = labelled.where("label is not null and doc_id is not null").groupBy("doc_id").agg(
        F.min(one).alias("label")
    )
    counted = (
        found.where("terms is not null").join(label, "doc_id").select("label", "terms")
        .mapInArrow(_by_label(len(every)), "term int, toxic long, other long")
        .groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other")).toArrow()
    )
    gain[counted["term"].to_numpy()] = _gains(
        counted["toxic"].to_numpy(), counted["other"].to_numpy(), prior
    )
    weight = (np.log((1 + texts.count()) / (1 + frequency)) + 1) * gain
    vectors = []
    for t, n in zip(terms, counts):
        w = (1 + np.log(n)) * weight[t]
        vectors.append((t, w / np.sqrt((w * w).sum()) if len(t) else w))
    return build(Vocabulary(every, weight), vectors, toxic, ids, prior)


def score(docs: DataFrame, held) -> DataFrame:
    """(doc_id, score, evidence): the calibrated chance of a toxic label, and the nearest
    examples with their labels and cosines, nearest first.

    ``held`` is a broadcast ``Neighbourhood``. A text's vector is of the words that examples
    have; a copy of an example has a cosine of 1 with it. Null, empty and wordless texts, and
    those without any word of an example, have no evidence and the share of such examples as
    their score. Repeated rows are scored alike; columns other than doc_id and text are left out.
    """
    words.small_batches(docs)
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    id_type = rows.schema["doc_id"].dataType
    kind, arrow_id = id_type.simpleString(), to_arrow_type(id_type)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        near = held.value
        ids, toxic = pa.array(near.ids, arrow_id), pa.array(near.toxic > 0)
        names = ["doc_id", "toxic", "cosine"]
        for batch in batches:
            for part in words.pieces(batch, "text", 1 << 20):
                vectors = near.vocabulary.vectors(*words.buffers(part.column("text")))
                votes, found, cosines = zip(*near.votes(vectors))
                ends = np.cumsum([0, *(len(f) for f in found)]).astype(np.int32)
                example = pa.array(np.concatenate(found))
                evidence = pa.StructArray.from_arrays(
                    [ids.take(example), toxic.take(example), pa.array(np.concatenate(cosines))], names
                )
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id"), pa.array(near.calibrated(np.array(votes))),
                    pa.ListArray.from_arrays(pa.array(ends), evidence),
                ], ["doc_id", "score", "evidence"])

    return rows.mapInArrow(
        run, f"doc_id {kind}, score double,"
        f"evidence array<struct<doc_id: {kind}, toxic: boolean, cosine: double>>"
    )
