"""Alignment of two tokenizers' tokens over the bytes of a text.

Both tokenizers cut the same bytes. Where both end a token, the text falls into groups that
neither crosses. The common ends are found by galloping: every end of the shorter list starts
at its proportional place in the longer one, steps away from it in doubling strides until it
is passed, and ends with a binary search in the last stride; all ends do so at once, as array
lanes. The ranks found on the way tell, for every token of the shorter list, which tokens of
the longer one it overlaps: the links.

How many documents hold a pair of ids linked is counted over the whole corpus. Documents
are tokenized and aligned once, in pieces of about half a megabyte. A piece is stored as one
row: its distinct pairs, and for each document which of them it holds how often, packed. The
pairs of all pieces are summed, the sums are joined back to the pairs of the pieces, and each
piece meets its own pairs again. So what is shuffled is the packed pieces and a row per piece
and pair, not a row per token or link; no table is broadcast.
"""

from __future__ import annotations

import hashlib
import json
import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from planlens.llm.text import pieces, small_batches
from planlens.session import settle

PIECE_BYTES = 1 << 19
_ENCODED_BYTES = 1 << 16  # of texts at once: what a tokenizer returns is many times its text

# -- tokenizers --------------------------------------------------------------------


def byte_alphabet() -> dict[str, int]:
    """Byte-level vocabularies write a printable Latin-1 byte as its character, and the others,
    in order, as the characters from U+0100 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(others)}


# How byte-level vocabularies of this kind cut a text before they merge bytes.
_CUT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# Letters, digits, punctuation and white space on whose classes every Unicode table agrees.
_COMMON = re.compile("[\t\n\r\x20-\x7e\u00a1-\u00ac\u00ae-\u024f\u2010-\u2027\u2030-\u205e\u20a0-\u20bf]*")
_LONG_RUN = re.compile(r"\S{400}|\s{400}")


class ByteLevel:
    """A byte-level tokenizer of the ``tokenizers`` library, over a space and the text.

    Its vocabulary numbers entries in the order of its merges, so that another library,
    ``tiktoken``, does the same merges five times as fast. It is used where the two can't
    differ: for a model of this kind (checked when it is read), and texts of common
    characters without very long words.
    """

    def __init__(self, model: bytes) -> None:
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_str(model.decode())
        self._tokenizer.encode_special_tokens = True
        alphabet = byte_alphabet()
        vocabulary = self._tokenizer.get_vocab()
        self.entries = [b""] * (max(vocabulary.values()) + 1)
        added = {t["content"] for t in json.loads(model)["added_tokens"]}
        for entry, number in vocabulary.items():
            plain = entry in added
            self.entries[number] = entry.encode() if plain else bytes(alphabet[c] for c in entry)
        self._merger = self._same_merges(json.loads(model), added)

    def _same_merges(self, model: dict, added: set[str]):
        """A ``tiktoken`` encoding with the same merges, or None if the model isn't of the kind."""
        import tiktoken

        cut = model.get("pre_tokenizer") or {}
        kind = cut.get("type") == "ByteLevel" and cut.get("use_regex", True) and not cut.get("add_prefix_space")
        merges = model["model"].get("merges", [])
        pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
        vocabulary = model["model"]["vocab"]
        ordered = all(vocabulary.get(a + b) == 256 + k for k, (a, b) in enumerate(pairs))
        if not kind or not ordered or model.get("normalizer") or model["model"].get("ignore_merges"):
            return None
        ranks = {
            self.entries[n]: n for entry, n in vocabulary.items() if entry not in added and n < 256 + len(pairs)
        }
        return tiktoken.Encoding("own", pat_str=_CUT, mergeable_ranks=ranks, special_tokens={})

    def encode(self, texts: list[str]) -> list[list[int]]:
        if self._merger is None:
            return self._plainly(texts)
        out, others = [], []
        for n, text in enumerate(texts):
            if _COMMON.fullmatch(text) and not _LONG_RUN.search(text):
                out.append(self._merger.encode_ordinary(f" {text}"))
            else:
                out.append([])
                others.append(n)
        if others:
            for n, ids in zip(others, self._plainly([texts[n] for n in others])):
                out[n] = ids
        return out

    def _plainly(self, texts: list[str]) -> list[list[int]]:
        batch = self._tokenizer.encode_batch_fast([f" {t}" for t in texts], add_special_tokens=False)
        return [e.ids for e in batch]


class Pieces:
    """A ``sentencepiece`` model, which adds the space itself."""

    def __init__(self, model: bytes) -> None:
        import sentencepiece

        self._model = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.entries = []
        for number in range(self._model.get_piece_size()):
            piece = self._model.id_to_piece(number)
            is_byte = self._model.is_byte(number)
            self.entries.append(
                bytes([int(piece[3:-1], 16)]) if is_byte else piece.replace("▁", " ").encode()
            )

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self._model.encode(texts, num_threads=1)


class Reader:
    """A tokenizer and its entries as arrays; ``encode`` gives ids, ends in bytes and the
    bytes of a list of texts, one after the other."""

    def __init__(self, tokenizer) -> None:
        self.tokenizer = tokenizer
        self.lengths = np.array([len(e) for e in tokenizer.entries], np.int64)
        self.bytes = pa.array(tokenizer.entries, pa.large_binary())

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, and where each text's begin and end."""
        parts, sizes, group, held = [np.zeros(0, np.int32)], [0], [], 0
        for n, text in enumerate(texts, 1):
            group.append(text)
            held += len(text)
            if held >= _ENCODED_BYTES or n == len(texts):
                for ids in self.tokenizer.encode(group):
                    parts.append(np.array(ids, np.int32))
                    sizes.append(len(ids))
                group, held = [], 0
        return np.concatenate(parts), np.cumsum(sizes)

    def joined(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of the tokens, joined."""
        return buffers_of(self.bytes.take(pa.array(ids)))


def buffers_of(values: pa.Array) -> np.ndarray:
    data = values.buffers()[2]
    offsets = np.frombuffer(values.buffers()[1], np.int64)[values.offset:values.offset + len(values) + 1]
    if data is None or not len(values):
        return np.zeros(0, np.uint8)
    return np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]]


# -- alignment ---------------------------------------------------------------------


def gallop(
    values: np.ndarray, within: np.ndarray, first: np.ndarray, last: np.ndarray, start: np.ndarray
) -> np.ndarray:
    """The place of the first element of ``within[first:last]`` that reaches each value.

    Each lane has its own sorted list ``within[first:last]``, not empty and with an element
    that reaches its value, and looks from ``start`` in it.
    """
    lo, hi = first.copy(), last - 1  # the place is in [lo, hi]
    below = within[start] < values
    # Stride away from the start, up or down, until the value is between two strides.
    lo[below] = start[below] + 1
    hi[~below] = start[~below]
    lanes, stride = np.arange(len(values)), 1
    while len(lanes):
        up = below[lanes]
        probe = np.where(up, start[lanes] + stride, start[lanes] - stride)
        inside = (probe >= lo[lanes]) & (probe <= hi[lanes])
        lanes, probe, up = lanes[inside], probe[inside], up[inside]
        less = within[probe] < values[lanes]
        lo[lanes[less]] = probe[less] + 1
        hi[lanes[~less]] = probe[~less]
        lanes = lanes[less == up]  # not passed yet
        stride *= 2
    lanes = np.flatnonzero(lo < hi)
    while len(lanes):
        middle = (lo[lanes] + hi[lanes]) // 2
        less = within[middle] < values[lanes]
        lo[lanes[less]] = middle[less] + 1
        hi[lanes[~less]] = middle[~less]
        lanes = lanes[lo[lanes] < hi[lanes]]
    return lo


class Alignment:
    """Of the tokens of many texts: ``a_ends`` and ``b_ends`` are ends in bytes that go on
    from text to text, ``a_bounds`` and ``b_bounds`` where a text's tokens begin and end.

    ``a``, ``b`` and ``text`` are the token numbers of both sides and the text of each link,
    ``a_last`` and ``b_last`` the last tokens of each group.
    """

    def __init__(self, a_ends, a_bounds, b_ends, b_bounds) -> None:
        n_a, n_b = np.diff(a_bounds), np.diff(b_bounds)
        a_text, b_text = np.repeat(np.arange(len(n_a)), n_a), np.repeat(np.arange(len(n_b)), n_b)
        drives = n_a <= n_b  # A's list is the shorter one
        one = self._links(a_ends, a_bounds, b_ends, b_bounds, np.flatnonzero(drives[a_text]), a_text)
        other = self._links(b_ends, b_bounds, a_ends, a_bounds, np.flatnonzero(~drives[b_text]), b_text)
        self.a = np.concatenate([one[0], other[1]])
        self.b = np.concatenate([one[1], other[0]])
        self.text = np.concatenate([a_text[one[0]], b_text[other[0]]])
        order = np.lexsort((self.b, self.a))
        self.a, self.b, self.text = self.a[order], self.b[order], self.text[order]
        self.a_last = np.sort(np.concatenate([one[2], other[3]]))
        self.b_last = np.sort(np.concatenate([one[3], other[2]]))
        self.n_groups = np.bincount(a_text[self.a_last], minlength=len(n_a))

    @staticmethod
    def _links(ends, bounds, within, within_bounds, tokens, text):
        """Links of the ``tokens`` of the shorter lists, and the tokens at common ends."""
        k = text[tokens]
        first, last = within_bounds[k], within_bounds[k + 1]
        share = (tokens - bounds[k]) * (last - first) // np.maximum(bounds[k + 1] - bounds[k], 1)
        at = gallop(ends[tokens], within, first, last, np.minimum(first + share, last - 1))
        common = within[at] == ends[tokens]
        # A token overlaps those from the one after the last end before it, to that of its end.
        begun = np.where(tokens == bounds[k], first, np.roll(at + common, 1))
        count = at - begun + 1
        mine = np.repeat(tokens, count)
        offset = np.arange(len(mine)) - np.repeat(np.cumsum(count) - count, count)
        theirs = np.repeat(begun, count) + offset
        return mine, theirs, tokens[common], at[common]


def _digests(a_ids, b_ids, alignment: Alignment, a_bounds, b_bounds, texts: int) -> list[str]:
    """SHA-256 of each text's groups, written ``a1,a2|b1;a3|b2,b3``."""
    a_end, b_end = np.zeros(len(a_ids), bool), np.zeros(len(b_ids), bool)
    a_end[alignment.a_last] = b_end[alignment.b_last] = True
    # In the written order A's tokens of a group come before B's.
    a_group, b_group = np.cumsum(a_end) - a_end, np.cumsum(b_end) - b_end
    b_before = np.concatenate([[0], alignment.b_last + 1])[a_group]
    a_before = alignment.a_last[b_group] + 1
    numbers = np.empty(len(a_ids) + len(b_ids), np.int64)
    marks = np.empty(len(numbers), np.uint8)
    for ids, before, end, last in ((a_ids, b_before, a_end, 124), (b_ids, a_before, b_end, 59)):
        place = np.arange(len(ids)) + before
        numbers[place] = ids
        marks[place] = np.where(end, last, 44)
    digits = pa.array(numbers).cast(pa.large_string())
    sizes = np.diff(np.frombuffer(digits.buffers()[1], np.int64)[:len(numbers) + 1])
    written = np.empty(int(sizes.sum()) + len(numbers), np.uint8)
    is_mark = np.zeros(len(written), bool)
    at = np.cumsum(sizes + 1)
    is_mark[at - 1] = True
    written[is_mark] = marks
    written[~is_mark] = buffers_of(digits)
    edges = np.concatenate([[0], at])[a_bounds + b_bounds]
    raw = written.tobytes()
    return [
        hashlib.sha256(raw[lo:hi - 1]).hexdigest() if hi > lo else ""
        for lo, hi in zip(edges[:-1].tolist(), edges[1:].tolist())
    ]


Make = Callable[[], tuple[Reader, Reader]]
_readers: dict[str, Reader] = {}


def _reader(kind: type, held) -> Reader:
    """Made once per worker and model."""
    key = f"{kind.__name__} {hashlib.sha256(held.value).hexdigest()}"
    if key not in _readers:
        _readers[key] = Reader(kind(held.value))
    return _readers[key]


# -- DataFrames --------------------------------------------------------------------


def _encode(part: pa.RecordBatch, a: Reader, b: Reader):
    """Ids and bounds of both sides for the texts of a batch; equal texts are encoded once. A
    text that is null, empty, or not given back by both tokenizers has no tokens."""
    texts = [t or "" for t in part.column("text").to_pylist()]
    distinct = {t: n for n, t in enumerate(dict.fromkeys(t for t in texts if t))}
    source = list(distinct)
    ok = np.ones(len(source), bool)
    sides = []
    for side in (a, b):
        ids, bounds = side.encode(source)
        joined = side.joined(ids)
        ends = np.concatenate([[0], np.cumsum(side.lengths[ids])])[bounds]
        for n, text in enumerate(source):
            ok[n] &= joined[ends[n]:ends[n + 1]].tobytes() == b" " + text.encode()
        sides.append((ids, bounds))
    row = [distinct[t] if t and ok[distinct[t]] else -1 for t in texts]
    for ids, bounds in sides:
        found = [ids[bounds[r]:bounds[r + 1]] if r >= 0 else ids[:0] for r in row]
        yield np.concatenate(found).astype(np.int64), np.cumsum([0, *map(len, found)])


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with about ``PIECE_BYTES`` of text each time, or one longer text."""
    held, size = [], 0
    for batch in batches:
        for part in pieces(batch, "text", PIECE_BYTES):
            held.append(part)
            size += part.column("text").nbytes
            if size >= PIECE_BYTES:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held, size = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


_COUNTS = ("n_a", "n_b", "n_groups", "n_links")
RESULT = (
    "n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint,"
    " groups_sha256 string"
)


def _pack(values: np.ndarray) -> bytes:
    return zlib.compress(values.astype("<u4").tobytes(), 1)


def _unpack(packed: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(packed), "<u4").astype(np.int64)


def _align_pieces(make: Make, id_type: pa.DataType):
    """A row per piece: per document its id, counts and digest; the distinct pairs, sorted, and
    how many of the piece's documents hold each; packed, per document how many distinct pairs
    it has, and of each its place among the pairs and how often it is linked."""

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        a, b = make()
        task = TaskContext.get().partitionId()
        for nth, part in enumerate(_pieces(batches)):
            n = part.num_rows
            (a_ids, a_bounds), (b_ids, b_bounds) = _encode(part, a, b)
            found = Alignment(
                np.cumsum(a.lengths[a_ids]), a_bounds, np.cumsum(b.lengths[b_ids]), b_bounds
            )
            links = np.bincount(found.text, minlength=n)
            counts = (np.diff(a_bounds), np.diff(b_bounds), found.n_groups, links)
            digests = _digests(a_ids, b_ids, found, a_bounds, b_bounds, n)
            pairs, which = np.unique((a_ids[found.a] << 32) | b_ids[found.b], return_inverse=True)
            held, times = np.unique(found.text * max(len(pairs), 1) + which, return_counts=True)
            text, which = np.divmod(held, max(len(pairs), 1))
            documents = np.bincount(which, minlength=len(pairs))
            # One list per column, one row.
            row = lambda values, kind: pa.array([values], pa.list_(kind))
            ids = pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), part.column("doc_id").cast(id_type))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([(task << 33) + nth], pa.int64()), ids,
                    *[row(c.astype(np.int64), pa.int64()) for c in counts],
                    row(digests, pa.string()), row(pairs.astype(np.int64), pa.int64()),
                    row(documents.astype(np.int64), pa.int64()),
                    pa.array([_pack(np.bincount(text, minlength=n))], pa.binary()),
                    pa.array([_pack(which)], pa.binary()), pa.array([_pack(times)], pa.binary()),
                ],
                ["piece", "doc_id", *_COUNTS, "groups_sha256", "pair", "documents", "distinct", "which", "times"],
            )

    return over


def pair_counts(piece_pairs: DataFrame) -> DataFrame:
    """(pair, count, best): documents of each id pair, and whether its A id has none more
    frequent. ``pair`` holds A's id in the upper 32 bits, B's in the lower."""
    counts = piece_pairs.groupBy("pair").agg(F.sum("documents").alias("count"))
    # At most one row per pair of ids: an id's rows are bounded by the other vocabulary.
    highest = F.max("count").over(Window.partitionBy(F.shiftright("pair", 32)))
    return counts.select("pair", "count", (F.col("count") == highest).alias("best"))


def _report(key, piece: pa.Table, known: pa.Table) -> pa.Table:
    """The documents of a piece, with the sums of the counts of their links."""
    order = np.argsort(np.asarray(known.column("pair")))
    counts, best = (np.asarray(known.column(c)).astype(np.int64)[order] for c in ("count", "best"))
    lists = {c: piece.column(c).combine_chunks().flatten() for c in ("doc_id", *_COUNTS, "groups_sha256")}
    distinct, which, times = (_unpack(piece.column(c)[0].as_py()) for c in ("distinct", "which", "times"))
    edges = np.cumsum([0, *distinct])

    def summed(values: np.ndarray) -> pa.Array:
        totals = np.concatenate([[0], np.cumsum(values[which] * times)])[edges]
        return pa.array(np.diff(totals), pa.int64())

    columns = [lists["doc_id"], *[lists[c] for c in _COUNTS], summed(best), summed(counts), lists["groups_sha256"]]
    return pa.Table.from_arrays(
        columns, names=["doc_id", *_COUNTS, "n_best", "count_sum", "groups_sha256"]
    )


def readers(spark, byte_level: str, piece_model: str) -> Make:
    """Two tokenizers from the files at these paths, which only the driver has to see: a file
    of fixed size goes to the workers as it is."""
    helds = []
    for path in (byte_level, piece_model):
        with open(path, "rb") as file:
            helds.append(spark.sparkContext.broadcast(file.read()))
    return lambda: (_reader(ByteLevel, helds[0]), _reader(Pieces, helds[1]))


def _texts(docs: DataFrame) -> tuple[DataFrame, str]:
    small_batches(docs)
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return rows, rows.schema["doc_id"].dataType.simpleString()


def align(docs: DataFrame, byte_level: str, piece_model: str) -> DataFrame:
    """How the tokens of two vocabularies align in each row of ``docs`` (doc_id, text).

    Returns doc_id, n_a, n_b (tokens), n_groups, n_links (overlapping pairs of tokens), n_best
    (links whose pair of ids is in most documents, ties included, of all pairs with its A
    id), count_sum (documents of its links' pairs, added up) and groups_sha256.

    Texts that are null, empty or not given back by both tokenizers have zeros and an empty
    digest. Repeated rows are documents of their own. An empty table gives an empty table;
    further columns are left out, whatever their names. A long text is a piece of its own.
    """
    make = readers(docs.sparkSession, byte_level, piece_model)
    rows, kind = _texts(docs)
    counts = ", ".join(f"{c} array<bigint>" for c in _COUNTS)
    stored = settle(rows.mapInArrow(
        _align_pieces(make, to_arrow_type(rows.schema["doc_id"].dataType)),
        f"piece bigint, doc_id array<{kind}>, {counts}, groups_sha256 array<string>,"
        " pair array<bigint>, documents array<bigint>, distinct binary, which binary, times binary",
    ))
    pairs = stored.select("piece", F.inline(F.arrays_zip("pair", "documents")))
    known = pairs.select(F.col("piece").alias("of_piece"), "pair").join(pair_counts(pairs), "pair")
    packed = stored.drop("pair", "documents")
    return packed.groupBy("piece").cogroup(known.groupBy("of_piece")).applyInArrow(
        _report, f"doc_id {kind}, {RESULT}"
    )


def links(docs: DataFrame, make: Make) -> DataFrame:
    """(doc_id, a_ids, b_ids, a, b) of each row of ``docs``: the ids of both tokenizers, and of
    each link the token numbers, from 0, in two arrays of the same length, by a, then b."""
    rows, kind = _texts(docs)

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = make()
        for part in _pieces(batches):
            (a_ids, a_bounds), (b_ids, b_bounds) = _encode(part, a, b)
            found = Alignment(
                np.cumsum(a.lengths[a_ids]), a_bounds, np.cumsum(b.lengths[b_ids]), b_bounds
            )
            edges = np.searchsorted(found.text, np.arange(part.num_rows + 1))
            columns = [
                (a_ids, a_bounds), (b_ids, b_bounds),
                (found.a - a_bounds[found.text], edges), (found.b - b_bounds[found.text], edges),
            ]
            lists = [
                pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(flat, pa.int32()))
                for flat, bounds in columns
            ]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), *lists], ["doc_id", "a_ids", "b_ids", "a", "b"]
            )

    arrays = ", ".join(f"{c} array<int>" for c in ("a_ids", "b_ids", "a", "b"))
    return rows.mapInArrow(over, f"doc_id {kind}, {arrays}")
