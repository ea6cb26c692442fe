"""Benchmark decontamination with a generalised suffix automaton.

The automaton of all item texts accepts every run of words that occurs in any item.
Documents are streamed through it word by word; the state keeps the longest run ending at
the current word that occurs in some item. Wherever that run is at least a window long,
its last window is an occurrence.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructField, StructType

from planlens.llm.text import WORD, small_batches

WINDOW = 10
SHARD_WORDS = 200_000  # item words per automaton; more items take more passes

_WORDS = re.compile(WORD)
# A-Z only: other letters keep their case.
_LOWER = {c: c + 32 for c in range(65, 91)}


def words(text: str | None) -> list[str]:
    return _WORDS.findall(text.translate(_LOWER)) if text else []


class Automaton:
    """Suffix automaton over the words of several items, with the items of each window.

    ``windows[s]``: for a state of length >= ``window``, the ancestor that stands for the
    last ``window`` words. ``items[w]``: the items that hold the window of state ``w``.
    ``shorts[s]``: (length, item) of items shorter than a window that end at state ``s``.
    """

    def __init__(self, items: list[tuple[str, list[str]]], window: int = WINDOW) -> None:
        self.window = window
        self.moves: list[dict[str, int]] = [{}]
        self.link, self.length = [-1], [0]
        for _, tokens in items:
            last = 0
            for token in tokens:
                last = self._extend(last, token)
        self._mark(items)

    def _add(self, length: int, moves: dict[str, int], link: int) -> int:
        self.moves.append(moves)
        self.length.append(length)
        self.link.append(link)
        return len(self.moves) - 1

    def _split(self, parent: int, token: str, target: int) -> int:
        """A copy of ``target`` for the runs that reach it by way of ``parent``."""
        copy = self._add(self.length[parent] + 1, dict(self.moves[target]), self.link[target])
        self.link[target] = copy
        while parent >= 0 and self.moves[parent].get(token) == target:
            self.moves[parent][token] = copy
            parent = self.link[parent]
        return copy

    def _extend(self, last: int, token: str) -> int:
        known = self.moves[last].get(token)
        if known is not None:
            if self.length[known] == self.length[last] + 1:
                return known
            return self._split(last, token, known)
        new = self._add(self.length[last] + 1, {}, 0)
        state = last
        while state >= 0 and token not in self.moves[state]:
            self.moves[state][token] = new
            state = self.link[state]
        if state >= 0:
            target = self.moves[state][token]
            if self.length[target] != self.length[state] + 1:
                target = self._split(state, token, target)
            self.link[new] = target
        return new

    def _mark(self, items: list[tuple[str, list[str]]]) -> None:
        order = sorted(range(len(self.moves)), key=self.length.__getitem__)
        self.windows = [0] * len(order)
        for state in order:
            if self.length[state] >= self.window:
                parent = self.link[state]
                inherits = self.length[parent] >= self.window
                self.windows[state] = self.windows[parent] if inherits else state
        self.items: dict[int, set[str]] = {}
        ends: dict[int, list[tuple[int, str]]] = {}
        for item, tokens in items:
            state = 0
            for at, token in enumerate(tokens, 1):
                state = self.moves[state][token]
                if at >= self.window:
                    self.items.setdefault(self.windows[state], set()).add(item)
            if 0 < len(tokens) < self.window:
                ends.setdefault(state, []).append((len(tokens), item))
        self.shorts: list[tuple[tuple[int, str], ...]] = [()] * len(order)
        for state in order[1:]:
            self.shorts[state] = self.shorts[self.link[state]] + tuple(ends.get(state, ()))

    def match(self, tokens: list[str]) -> tuple[list[tuple[int, int]], set[str]]:
        """Merged (first, past the last) spans of window occurrences, and their items."""
        moves, link, length = self.moves, self.link, self.length
        window, shorts = self.window, self.shorts
        spans: list[list[int]] = []
        seen: set[int] = set()
        found: set[str] = set()
        state = run = 0
        for at, token in enumerate(tokens, 1):
            target = moves[state].get(token)
            if target is None:
                while state:
                    state = link[state]
                    target = moves[state].get(token)
                    if target is not None:
                        run = length[state] + 1
                        state = target
                        break
                else:
                    run = 0
                    continue
            else:
                run += 1
                state = target
            reach = 0
            if run >= window:
                reach = window
                seen.add(self.windows[state])
            if shorts[state]:
                for size, item in shorts[state]:
                    if size <= run:
                        reach = max(reach, size)
                        found.add(item)
            if reach:
                start = at - reach
                # A later span may reach further back than an earlier one.
                while spans and spans[-1][0] >= start:
                    spans.pop()
                if spans and spans[-1][1] >= start:
                    spans[-1][1] = at
                else:
                    spans.append([start, at])
        for state in seen:
            found |= self.items[state]
        return [(a, b) for a, b in spans], found


def shards(benchmark: DataFrame, size: int = SHARD_WORDS) -> Iterator[list[tuple[str, list[str]]]]:
    """Items in groups of at most ``size`` words (or one item), streamed from the table.

    Held at once is one group, whatever the number of items. Ids are read as text; null
    ids as the empty text; null or wordless items have no window.
    """
    group: list[tuple[str, list[str]]] = []
    held = 0
    rows = benchmark.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"),
        F.col("text").cast("string").alias("text"),
    )
    for row in rows.toLocalIterator():
        tokens = words(row.text)
        if group and held + len(tokens) > size:
            yield group
            group, held = [], 0
        if tokens:
            group.append((row.item, tokens))
            held += len(tokens)
    yield group


SPAN_SCHEMA = "n_words long, spans array<struct<first: int, past: int>>, items array<string>"


def _matcher(held, position: int):
    """Appends words, spans and items to each row; the text is column ``position``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = held.value
        kind = pa.list_(pa.struct([("first", pa.int32()), ("past", pa.int32())]))
        for batch in batches:
            counts, spans, items = [], [], []
            for text in batch.column(position):
                tokens = words(text.as_py())
                hits, found = automaton.match(tokens)
                counts.append(len(tokens))
                spans.append([{"first": a, "past": b} for a, b in hits])
                items.append(sorted(found))
            columns = [
                pa.array(counts, pa.int64()), pa.array(spans, kind),
                pa.array(items, pa.list_(pa.string())),
            ]
            yield pa.RecordBatch.from_arrays(
                batch.columns + columns, batch.schema.names + ["n_words", "spans", "items"]
            )

    return run


def merge_spans(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    merged: list[list[int]] = []
    for first, past in sorted(spans):
        if merged and first <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], past)
        else:
            merged.append([first, past])
    return [(a, b) for a, b in merged]


def _merge_groups(groups):
    return merge_spans([(s["first"], s["past"]) for g in groups for s in g])


def find_spans(
    docs: DataFrame, benchmark: DataFrame, *, window: int = WINDOW, shard_words: int = SHARD_WORDS
) -> DataFrame:
    """(doc_id, text) of ``docs`` plus n_words, spans (word positions) and items.

    Null or empty texts have no words; a text without an occurrence has empty spans and
    items; repeated rows each get their own row; an empty benchmark finds nothing. One
    pass reads each document once per shard of items, and the passes' spans are merged.
    """
    small_batches(docs)
    spark = docs.sparkSession
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    passes = []
    for group in shards(benchmark, shard_words):
        held = spark.sparkContext.broadcast(Automaton(group, window))
        schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
        passes.append(rows.mapInArrow(_matcher(held, 1), f"{schema}, {SPAN_SCHEMA}"))
    if len(passes) == 1:
        return passes[0]
    # Equal rows give equal spans, so a row's spans from all passes meet under its own value.
    merged = F.udf(_merge_groups, "array<struct<first: int, past: int>>")
    every = reduce(DataFrame.unionByName, passes)
    shards_n = len(passes)
    return (
        every.groupBy("doc_id", "text")
        .agg(
            F.first("n_words").alias("n_words"),
            F.collect_set("spans").alias("groups"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
            (F.count("*") / shards_n).cast("int").alias("copies"),
        )
        .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
        .select("doc_id", "text", "n_words", merged("groups").alias("spans"), "items")
    )


def hit_words(spans) -> F.Column:
    return F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + s["past"] - s["first"])


def report(found: DataFrame) -> DataFrame:
    """Per document: how many words lie in windows, of which items."""
    hits = hit_words(F.col("spans"))
    return found.select(
        "doc_id", "n_words", hits.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
        (hits > 0).alias("contaminated"),
    )


def cut(text: str | None, spans: list[tuple[int, int]]) -> str | None:
    """``text`` without the words of ``spans``, the space around a cut becoming one space."""
    if not spans:
        return text
    places = [m.span() for m in _WORDS.finditer(text.translate(_LOWER))]
    kept, at = [], 0
    for first, past in spans:
        kept.append(text[at:places[first][0]].rstrip())
        at = places[past - 1][1]
    kept.append(text[at:].lstrip())
    return " ".join(part for part in kept if part)


def clean(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    window: int = WINDOW,
    max_span: int = 0,
    max_coverage: float = 0.5,
    shard_words: int = SHARD_WORDS,
) -> DataFrame:
    """``docs`` without benchmark spans: spans of more than ``max_span`` words are cut out,
    and a document whose spans cover more than ``max_coverage`` of its words is dropped.

    Returns the columns of ``docs``. Texts without an occurrence, null and empty ones
    included, come back unchanged; every repeated row is handled alike. Every pass looks at
    the whole text; the last one merges the spans of all, decides and cuts, so the result
    doesn't depend on ``shard_words``.
    """
    small_batches(docs)
    position = docs.columns.index("text")
    spare = "spans"
    while spare in {c.lower() for c in docs.columns}:
        spare = f"_{spare}"
    kind = pa.list_(pa.list_(pa.int32()))

    def run(held, first: bool, last: bool):
        def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            automaton = held.value
            for batch in batches:
                columns = list(batch.columns)
                before = [()] * batch.num_rows if first else columns.pop().to_pylist()
                keep, texts, found = [], [], []
                for text, earlier in zip(batch.column(position), before):
                    text = text.as_py()
                    tokens = words(text)
                    spans, _ = automaton.match(tokens)
                    spans = [*map(tuple, earlier), *spans]
                    if not last:
                        found.append(spans)
                        continue
                    spans = [s for s in merge_spans(spans) if s[1] - s[0] > max_span]
                    covered = sum(b - a for a, b in spans)
                    keep.append(covered <= max_coverage * len(tokens))
                    texts.append(cut(text, spans))
                if not last:
                    names = [*batch.schema.names[:len(columns)], spare]
                    yield pa.RecordBatch.from_arrays([*columns, pa.array(found, kind)], names)
                    continue
                columns[position] = pa.array(texts, batch.schema.field(position).type)
                whole = pa.RecordBatch.from_arrays(columns, names=batch.schema.names[:len(columns)])
                yield whole.filter(pa.array(keep, pa.bool_()))

        return over

    spark, schema = docs.sparkSession, docs.schema
    helds = [spark.sparkContext.broadcast(Automaton(g, window)) for g in shards(benchmark, shard_words)]
    carried = StructType([*schema.fields, StructField(spare, ArrayType(ArrayType(IntegerType())))])
    for n, held in enumerate(helds, 1):
        last = n == len(helds)
        docs = docs.mapInArrow(run(held, n == 1, last), schema if last else carried)
    return docs
