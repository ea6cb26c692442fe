"""Words, word hashes and shingles of whole Arrow batches, as numpy arrays.

A word is a run of digits, letters a-z (A-Z are lower-cased) and bytes above 0x7F,
the UTF-8 form of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` over lower-cased text.
Everything works on the bytes of the batch; there is no loop per word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_WORD = np.zeros(256, dtype=bool)
_IS_WORD[48:58] = _IS_WORD[97:123] = _IS_WORD[128:] = True

BATCH_ROWS = 256
_PIECE = 1 << 18  # bytes hashed at a time
_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def buffers(texts: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column and the offsets of its rows; null reads as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    if data is None or not len(texts):
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]], offsets - offsets[0]


def small_batches(df: DataFrame) -> None:
    """Bounds the Arrow batches of the session to ``BATCH_ROWS`` texts: a batch is held by the
    JVM and by the Python worker at once."""
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(df.sparkSession.conf.get(setting)) != BATCH_ROWS:
        df.sparkSession.conf.set(setting, str(BATCH_ROWS))


def pieces(batch: pa.RecordBatch, column: str, size: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of ``batch`` with about ``size`` bytes of text each, whole rows only."""
    if not batch.num_rows:
        return
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    group = np.cumsum(lengths) // size
    cuts = np.flatnonzero(np.diff(group)) + 1
    for lo, hi in zip([0, *cuts], [*cuts, batch.num_rows]):
        yield batch.slice(lo, hi - lo)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power_table(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = max(_PIECE, n) + 1
    if size not in _powers:
        _powers.clear()
        tables = []
        for base in (_BASE, _BASE_INVERSE):
            table = np.full(size, base, np.uint64)
            table[0] = 1
            tables.append(np.cumprod(table, dtype=np.uint64))
        _powers[size] = tuple(tables)
    return _powers[size]


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash per word in order, and the offsets of each row's words."""
    found, begun = [], []
    lo, total = 0, len(data)
    edges = offsets[(offsets > 0) & (offsets < total)]
    while lo < total:
        hi = min(lo + _PIECE, total)
        if hi < total:  # move the cut forward to a place between two words
            while hi < total and _IS_WORD[_LOWER[data[hi]]]:
                hi += 1
        part = _LOWER[data[lo:hi]]
        inside = _IS_WORD[part]
        edge = edges[np.searchsorted(edges, lo):np.searchsorted(edges, hi)] - lo
        before = np.empty_like(inside)
        before[0] = False
        before[1:] = inside[:-1]
        before[edge] = False
        after = np.empty_like(inside)
        after[-1] = False
        after[:-1] = inside[1:]
        after[edge[edge > 0] - 1] = False
        starts = np.flatnonzero(inside & ~before)
        ends = np.flatnonzero(inside & ~after) + 1
        up, down = _power_table(len(part))
        sums = np.empty(len(part) + 1, np.uint64)
        sums[0] = 0
        np.cumsum((part.astype(np.uint64) + np.uint64(1)) * up[:len(part)], out=sums[1:])
        found.append(mix((sums[ends] - sums[starts]) * down[starts]))
        begun.append(starts + lo)
        lo = hi
    if not found:
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    hashes, positions = np.concatenate(found), np.concatenate(begun)
    return hashes, np.searchsorted(positions, offsets)


def shingle_sets(
    data: np.ndarray, offsets: np.ndarray, width: int = 5
) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of each row's runs of ``width`` words.

    A text of fewer words, but some, is one shingle; a text without words has none.
    """
    words, bounds = word_hashes(data, offsets)
    n = max(0, len(words) - width + 1)
    runs = np.zeros(n, np.uint64)
    for k in range(width):
        runs = runs * np.uint64(0xD6E8FEB86659FD93) + words[k:k + n]
    runs = mix(runs)
    sets = []
    for lo, hi in zip(bounds[:-1], bounds[1:]):
        if hi - lo >= width:
            sets.append(np.unique(runs[lo:hi - width + 1]))
        elif hi > lo:
            short = np.array([hi - lo], np.uint64)
            for w in words[lo:hi]:
                short = short * np.uint64(0xD6E8FEB86659FD93) + w
            sets.append(mix(short))
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets
