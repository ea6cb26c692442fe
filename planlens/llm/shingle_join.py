"""Jaccard self-join of texts on word shingles, with a MinHash LSH forest.

A tree of the forest labels every text with a MinHash value of ``LEVEL_BITS`` bits per level;
sorted by label, texts with a common prefix stand together. The join starts at long prefixes and
shortens them. Texts with a common prefix in some tree are compared exactly, on their whole
sets of shingles. The join stops when the least similar links found are of a similarity whose
pairs share a prefix with the target recall as their chance. At the shortest prefix even pairs
just at the threshold do.

Equal texts are compared once, as a class of copies. A bucket whose texts are just those of
an earlier bucket is left out, and a pair counts in the first bucket that holds it, so
links are counted without listing pairs. A large bucket is cut into stripes, which are stored once
and compared with each other by different tasks.
"""

from __future__ import annotations

import io
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from planlens.llm import bloom
from planlens.llm import text as words
from planlens.llm.components import components
from planlens.llm.shared_files import fetch, store
from planlens.session import delete_on_exit, settle, shared_folder

WIDTH = 5  # words of a shingle
THRESHOLD = (4, 5)  # similarity as a fraction, so that it is compared without rounding
TREES = 16
# The shortest prefix in use, of three levels, has 44 bits: few of a billion texts share one by chance.
LEVEL_BITS = (16, 16, 12, 4, 4, 4, 4, 4)
LEVELS = len(LEVEL_BITS)
FIRST_DEPTH = 4  # finds all but links of less than 0.85; longer ones nearly always cost another round
TARGET_RECALL = 0.9999
STRIPE = 256  # texts of a bucket compared with each other in one piece
BINS = 20

_SEEDS = np.random.default_rng(20_240_917).integers(
    1, 2**63, size=(TREES * LEVELS, 2), dtype=np.uint64
) * np.uint64(2) + np.uint64(1)


def _rest(depth: int) -> int:
    """The bits of a label behind its first ``depth`` levels."""
    return sum(LEVEL_BITS[depth:])


def labels(sets: list[np.ndarray]) -> np.ndarray:
    """One 64-bit label per text and tree, first level first."""
    sizes = np.array([len(s) for s in sets])
    out = np.zeros((len(sets), TREES), np.uint64)
    some = np.flatnonzero(sizes)
    at = 0
    while at < len(some):  # about 64 thousand shingles at a time
        past = at + max(1, int(np.searchsorted(np.cumsum(sizes[some[at:]]), 1 << 16)))
        rows = some[at:past]
        flat = np.concatenate([sets[r] for r in rows])
        starts = np.concatenate([[0], np.cumsum(sizes[rows])[:-1]])
        for k, (seed, odd) in enumerate(_SEEDS):
            least = np.minimum.reduceat((flat ^ seed) * odd, starts)
            tree, level = divmod(k, LEVELS)
            value = words.mix(least) >> np.uint64(64 - LEVEL_BITS[level])
            out[rows, tree] |= value << np.uint64(_rest(level + 1))
        at = past
    return out


def found_chance(similarity: np.ndarray | float, depth: int) -> np.ndarray | float:
    """The least chance of a pair of that similarity to share a prefix of ``depth`` in some tree;
    narrow levels are also shared by accident."""
    return 1 - (1 - similarity**depth) ** TREES


def floor_depth(target: float) -> int:
    """The longest prefix that finds pairs just at the threshold with chance ``target``."""
    least = THRESHOLD[0] / THRESHOLD[1]
    depths = [d for d in range(LEVELS, 0, -1) if found_chance(least, d) >= target]
    if not depths:
        raise ValueError(f"{TREES} trees can't find pairs with a chance of {target}")
    return depths[0]


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in words.pieces(batch, "text"):
            found = labels(words.shingle_sets(*words.buffers(part.column("text")), WIDTH))
            flat = pa.array(found.view(np.int64).ravel())
            offsets = pa.array(np.arange(0, flat.__len__() + 1, TREES, dtype=np.int32))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("key"), pa.ListArray.from_arrays(offsets, flat)],
                ["doc_id", "key", "labels"],
            )


def _prefix(label, depth: int):
    return F.shiftrightunsigned(label, _rest(depth))


def _keyed(reps: DataFrame, depth: int) -> DataFrame:
    """(key, tree, prefix) of each text."""
    cut = F.transform("labels", lambda x: _prefix(x, depth))
    return reps.select("key", F.posexplode(cut).alias("tree", "prefix"))


def _buckets(keyed: DataFrame) -> DataFrame:
    """Buckets of two texts or more, each set of texts once, with the set's hash."""
    full = keyed.groupBy("tree", "prefix").agg(
        F.count("*").alias("n"),
        F.bit_xor(F.xxhash64("key")).alias("x"),
        F.bit_xor(F.xxhash64(F.reverse("key"))).alias("y"),
    ).where("n > 1")
    first = F.min(F.struct("tree", "prefix")).alias("first")
    return full.groupBy("n", "x", "y").agg(first).select("n", "x", "y", "first.*")


def overlaps(left: list[np.ndarray], right: list[np.ndarray] | None = None) -> np.ndarray:
    """The size of the intersection of every set on the left with every one on the right
    (None: with each other; the diagonal is then without meaning)."""
    sides = [left] if right is None else [left, right]
    flat = [np.concatenate(sets) for sets in sides]
    values, column = np.unique(np.concatenate(flat), return_inverse=True)
    columns = np.split(column, [len(flat[0])])[:len(sides)]
    seen = [np.bincount(c, minlength=len(values)) for c in columns]
    useful = seen[0] > 1 if right is None else (seen[0] > 0) & (seen[1] > 0)
    place = np.cumsum(useful) - 1
    entries = []
    for sets, c in zip(sides, columns):
        owner = np.repeat(np.arange(len(sets)), [len(one) for one in sets])
        kept = useful[c]
        owner, at = owner[kept], place[c[kept]]
        order = np.argsort(at, kind="stable")
        entries.append((len(sets), owner[order], at[order]))
    common = np.zeros((len(left), len(sides[-1])), np.float32)
    step = 8192
    for lo in range(0, int(useful.sum()), step):
        dense = []
        for n, owner, at in entries:
            a, b = np.searchsorted(at, [lo, lo + step])
            held = np.zeros((n, step), np.float32)
            held[owner[a:b], at[a:b] - lo] = 1
            dense.append(held)
        common += dense[0] @ dense[-1].T
    return common.astype(np.int64)


@dataclass
class Stripe:
    """Texts of a bucket, sorted by key, with what comparing them takes."""

    keys: np.ndarray
    copies: np.ndarray
    marks: np.ndarray  # a row of labels per text
    sets: list[np.ndarray]
    root: np.ndarray  # place of the least text of each one's component in the stripe

    def pack(self) -> bytes:
        """Near copies share most shingles, so that steps within a list of them are small."""
        values, at = np.unique(np.concatenate(self.sets), return_inverse=True)
        out = io.BytesIO()
        np.savez_compressed(
            out, keys=self.keys, copies=self.copies, marks=self.marks, root=self.root, values=values,
            sizes=np.array([len(one) for one in self.sets]), steps=np.diff(at.astype(np.int32), prepend=0),
        )
        return out.getvalue()

    @classmethod
    def unpack(cls, data: bytes) -> Stripe:
        with np.load(io.BytesIO(data)) as held:
            flat = held["values"][np.cumsum(held["steps"])]
            sets = np.split(flat, np.cumsum(held["sizes"])[:-1])
            return cls(held["keys"], held["copies"], held["marks"], sets, held["root"])


def linked(
    left: Stripe, right: Stripe | None, tree: int, depth: int, done_depth: int
) -> tuple[np.ndarray, np.ndarray]:
    """Which texts of two stripes of a bucket (None: of one) are linked, and a histogram of
    their similarities.

    A pair counts here unless a bucket before this one holds it: one of an earlier tree, or
    one of ``done_depth`` (0: none), the length of prefixes already compared.
    """
    other = left if right is None else right
    fresh = np.ones((len(left.keys), len(other.keys)), bool)
    if right is None:
        fresh = np.triu(fresh, 1)
    for trees, length in ((tree, depth), (TREES if done_depth else 0, done_depth)):
        a, b = left.marks >> np.uint64(_rest(length)), other.marks >> np.uint64(_rest(length))
        for t in range(trees):
            fresh &= a[:, None, t] != b[None, :, t]
    if not fresh.any():
        return fresh, np.zeros(BINS, np.int64)
    common = overlaps(left.sets, None if right is None else right.sets)
    sizes = [np.array([len(one) for one in side.sets], np.int64) for side in (left, other)]
    union = sizes[0][:, None] + sizes[1][None, :] - common
    found = fresh & (union > 0) & (THRESHOLD[1] * common >= THRESHOLD[0] * union)
    place = np.minimum((common[found] / union[found] * BINS).astype(np.int64), BINS - 1)
    return found, np.bincount(place, minlength=BINS)


def _least_roots(both: np.ndarray) -> np.ndarray:
    """The least text of each one's component, by symmetric links."""
    n = len(both)
    root = np.arange(n)
    while True:  # everyone takes the least root among its links
        low = np.minimum(root, np.where(both, root[None, :], n).min(1))
        low = low[low]
        if (low == root).all():
            return root
        root = low


_FOUND = "key string, links long, root string, bins array<long>"
_FOUND_ARROW = pa.schema([
    ("key", pa.string()), ("links", pa.int64()), ("root", pa.string()), ("bins", pa.list_(pa.int64())),
])


def _rows(found: list[tuple[str, int, str]], bins: np.ndarray) -> list[dict]:
    return [
        {"key": key, "links": links, "root": root, "bins": None if k else bins.tolist()}
        for k, (key, links, root) in enumerate(found)
    ]


def _stripe_name(row: dict, stripe: int) -> str:
    return f"{row['tree']}-{row['prefix'] & (2**64 - 1):016x}-{stripe}"


def _compare_stripes(depth: int, done_depth: int, folder: str):
    """Compares the texts of each run of rows of one bucket and stripe. Stripes of a bucket
    that has several are stored in ``folder`` for the comparison across stripes."""

    def emit(rows: list[dict]) -> list[dict]:
        rows = sorted({r["key"]: r for r in rows}.values(), key=lambda r: r["key"])
        if not rows or len(rows) == rows[0]["n"] == 1:
            return []
        texts = pa.array([r["text"] for r in rows], pa.large_string())
        one = Stripe(
            np.array([r["key"] for r in rows], "S32"),
            np.array([r["copies"] for r in rows], np.int64),
            np.array([r["labels"] for r in rows], np.int64).view(np.uint64),
            words.shingle_sets(*words.buffers(texts), WIDTH), np.arange(len(rows)),
        )
        pairs, bins = linked(one, None, rows[0]["tree"], depth, done_depth)
        both = pairs | pairs.T
        one.root = _least_roots(both)
        if rows[0]["stripes"] > 1:
            store(folder, _stripe_name(rows[0], rows[0]["stripe"]), one.pack())
        links = both @ one.copies
        return _rows(
            [(rows[i]["key"], int(links[i]), rows[one.root[i]]["key"]) for i in np.flatnonzero(links)], bins
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        bucket, out = None, []
        for row in (r for b in batches for part in words.pieces(b, "text") for r in part.to_pylist()):
            here = (row["tree"], row["prefix"], row["stripe"])
            if here != bucket:
                out += emit(held)
                held, bucket = [], here
                if len(out) >= 4096:
                    yield pa.RecordBatch.from_pylist(out, _FOUND_ARROW)
                    out = []
            held.append(row)
        out += emit(held)
        yield pa.RecordBatch.from_pylist(out, _FOUND_ARROW)

    return run


def _across_stripes(depth: int, done_depth: int, folder: str):
    """Compares a stripe (a row) with all others of its bucket, one at a time."""

    def compared(row: dict) -> list[dict]:
        load = lambda k: fetch(folder, _stripe_name(row, k))
        own = load(row["stripe"])
        if own is None:  # no text fell into this stripe
            return []
        own = Stripe.unpack(own)
        links, bins = np.zeros(len(own.keys), np.int64), np.zeros(BINS, np.int64)
        edges: set[tuple[str, str]] = set()
        met = len(own.keys)
        for k in range(row["stripes"]):
            data = load(k) if k != row["stripe"] else None
            if data is None:
                continue
            other = Stripe.unpack(data)
            met += len(other.keys)
            pairs, seen = linked(own, other, row["tree"], depth, done_depth)
            links += pairs @ other.copies
            if k > row["stripe"]:  # the other stripe counts its own links
                bins += seen
                a, b = np.nonzero(pairs)
                joined = np.unique(np.stack([own.root[a], other.root[b]], 1), axis=0)
                edges |= {(own.keys[x].decode(), other.keys[y].decode()) for x, y in joined}
        if met != row["n"]:
            raise RuntimeError(f"{met} of the {row['n']} texts of a bucket are stored")
        names = [key.decode() for key in own.keys]
        return _rows(
            [(names[i], int(links[i]), names[own.root[i]]) for i in np.flatnonzero(links)]
            + [(x, 0, y) for x, y in sorted(edges)], bins,
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                yield pa.RecordBatch.from_pylist(compared(row), _FOUND_ARROW)

    return run


def _round(candidates: DataFrame, live: DataFrame, depth: int, done_depth: int) -> DataFrame:
    """Compares the texts of the ``live`` buckets at this depth.

    A bucket is dealt to stripes of about ``STRIPE`` texts. Each text is moved once per bucket; a
    task compares the texts of a stripe and, if there are more stripes, stores it in a file.
    Then a row per stripe goes through the files of its bucket, so that rows and disk grow with
    the bucket, and only the comparing with its square.
    """
    spark = candidates.sparkSession
    folder = f"{shared_folder(spark)}/stripes/{uuid.uuid4().hex}"
    delete_on_exit(spark, folder)
    members = _keyed(candidates, depth).join(live.select("tree", "prefix", "n"), ["tree", "prefix"])
    held = members.groupBy("key").agg(F.collect_list(F.struct("tree", "prefix", "n")).alias("held"))
    count = F.ceil(F.col("n") / STRIPE).cast("int")
    rows = candidates.join(held, "key").select(
        "key", "copies", "labels", "text", F.inline("held")
    ).select(
        "tree", "prefix", F.pmod(F.xxhash64("key", "prefix"), count).cast("int").alias("stripe"),
        "n", count.alias("stripes"), "key", "copies", "labels", "text",
    )
    place = ["tree", "prefix", "stripe"]
    within = settle(rows.repartition(*place).sortWithinPartitions(*place).mapInArrow(
        _compare_stripes(depth, done_depth, folder), _FOUND
    ))
    stripes = live.where(F.col("n") > STRIPE).select(
        "tree", "prefix", "n", count.alias("stripes"),
        F.explode(F.sequence(F.lit(0), count - 1)).alias("stripe"),
    )
    across = stripes.repartition(*place).mapInArrow(_across_stripes(depth, done_depth, folder), _FOUND)
    return within.union(settle(across))


def _recall(bins: np.ndarray, depth: int) -> float:
    """The chance of the least similar of the links found, at the lower edge of their bin."""
    some = np.flatnonzero(bins)
    return float(found_chance(some[0] / BINS, depth)) if len(some) else 0.0


def similar(
    docs: DataFrame, *, target_recall: float = TARGET_RECALL, first_depth: int = FIRST_DEPTH
) -> tuple[DataFrame, DataFrame]:
    """Classes of copies, and what they are linked to.

    The first result has a row per row of ``docs``: doc_id, key (the copy class: the MD5 of
    the text). The second a row per class: key, doc_id (its least), copies, links (documents
    of other classes with a similarity of 0.8 or more), root (the least key of its connected
    component).

    Null texts read as empty. Texts without words are linked to none but are copies of
    each other if equal. Shorter texts than a shingle are one shingle. Repeated rows are
    copies. Null ids are no least id unless there is no other. Empty tables give empty results.
    """
    words.small_batches(docs)
    target = floor_depth(target_recall)
    body = F.coalesce(F.col("text").cast("string"), F.lit(""))
    texts = docs.select("doc_id", body.alias("text")).withColumn("key", F.md5("text"))
    kind = texts.schema["doc_id"].dataType.simpleString()
    signed = settle(texts.select("doc_id", "key", "text").mapInArrow(
        _signatures, f"doc_id {kind}, key string, labels array<long>"
    ))
    classes = settle(signed.groupBy("key").agg(
        F.min("doc_id").alias("doc_id"), F.count("*").alias("copies"),
        F.first("labels").alias("labels"),
    ))
    wordless = F.forall("labels", lambda x: x == 0)
    reps = classes.where(~wordless)

    # What shares no prefix at the shortest length is in no bucket of any round. Eight-byte
    # hashes stand for keys and buckets here; where two are equal by chance, one text more
    # is a candidate.
    widest = _keyed(reps, target).select(
        F.xxhash64("key").alias("r"), F.xxhash64("tree", "prefix").alias("bucket")
    )
    full = widest.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    crowded = widest.join(full, "bucket", "left_semi").select("r").distinct()
    least = settle(
        reps.join(crowded, F.xxhash64("key") == F.col("r"), "left_semi")
        .select("key", F.col("doc_id").alias("_least"), "copies", "labels")
    )
    near = bloom.marked(texts, F.col("key"), least.select("key"), "_near").where("_near")
    candidates = settle(
        near.join(least, "key").where(F.col("doc_id").eqNullSafe(F.col("_least")))
        .select("key", "copies", "labels", "text").dropDuplicates(["key"])
    )

    done: DataFrame | None = None
    found: list[DataFrame] = []
    bins = np.zeros(BINS)
    depth, done_depth = max(first_depth, target), 0
    while True:
        live = _buckets(_keyed(candidates, depth))
        if done is not None:
            live = live.join(done, ["n", "x", "y"], "left_anti")
        live = settle(live)
        found.append(_round(candidates, live, depth, done_depth))
        counts = found[-1].where("bins is not null").select(F.posexplode("bins").alias("bin", "n"))
        for row in counts.groupBy("bin").agg(F.sum("n").alias("n")).collect():  # BINS rows
            bins[row.bin] += row.n
        if depth <= target or _recall(bins, depth) >= target_recall:
            break
        sets = live.select("n", "x", "y")
        done = sets if done is None else done.union(sets)
        depth, done_depth = depth - 1, depth

    every = found[0]
    for more in found[1:]:
        every = every.union(more)
    links = every.groupBy("key").agg(F.sum("links").alias("links"))
    roots = components(every.select(F.col("key").alias("a"), F.col("root").alias("b")))
    linked = links.join(roots.withColumnRenamed("node", "key"), "key", "left")
    summary = classes.select("key", "doc_id", "copies").join(linked, "key", "left").select(
        "key", "doc_id", "copies", F.coalesce("links", F.lit(0)).cast("long").alias("links"),
        F.coalesce("root", "key").alias("root"),
    )
    return signed.select("doc_id", "key"), summary


def _with_groups(summary: DataFrame) -> DataFrame:
    group = summary.groupBy(F.col("root")).agg(
        F.min("doc_id").alias("group_id"),
        F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "key"))["key"].alias("kept_key"),
    )
    return summary.join(group, "root")


def link_counts(docs: DataFrame, **options) -> DataFrame:
    """Per document: class_id, the least doc_id of its connected group, and n_links, the
    other documents (copies included) at a similarity of 0.8 or more."""
    members, summary = similar(docs, **options)
    per_class = _with_groups(summary).select(
        "key", F.col("group_id").alias("class_id"),
        (F.col("links") + F.col("copies") - 1).alias("n_links"),
    )
    return members.join(per_class, "key").select("doc_id", "class_id", "n_links")


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """One document of each connected group: the one of the least doc_id. All columns of
    ``docs`` come back; of wholly repeated rows one stays."""
    _, summary = similar(docs, **options)
    grouped = settle(_with_groups(summary).select(
        "key", F.col("doc_id").alias("_kept_id"), (F.col("key") == F.col("kept_key")).alias("_kept"),
        ((F.col("copies") > 1) | (F.col("links") > 0)).alias("_shared"),
    ))
    key = F.md5(F.coalesce(F.col("text").cast("string"), F.lit("")))
    shared = grouped.where("_shared").select("key")
    rows = docs.select(F.struct("*").alias("row"), key.alias("_key"))
    split = bloom.marked(rows, F.col("_key"), shared, "_maybe")
    # What has neither copies nor links stays where it is; the rest meets its group.
    kept = grouped.where("_kept").select(F.col("key").alias("_key"), "_kept_id")
    chosen = (
        split.where("_maybe").join(kept, "_key")
        .where(F.col("row.doc_id").eqNullSafe(F.col("_kept_id"))).dropDuplicates(["_key"])
    )
    return split.where(~F.col("_maybe")).select("row.*").union(chosen.select("row.*"))
