"""Order MinHash fingerprints, sensitive to edits and to the order of words.

Marcais et al., "Locality-sensitive hashing for the edit distance", 2019, over runs of
``K`` words, numbered by their occurrence in the text so that repeats count. One hash deals the
numbered runs out to ``BINS`` bins, as in one-permutation hashing; of every bin the two runs
of least hash are kept, put back in text order, and hashed together. Two texts are as like as
the share of bins, of those that either fills, in which both have the same pair.

DataFrame functions only. A text's work stays in its own row: nothing is exploded.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from planlens.llm.ordering import placed

K = 3  # words of a run
BINS = 64
_BIN_BITS = 6
_PLACE_BITS = 24  # low bits of a packed value: where in the text a run begins
_PAIR_BITS = 24  # of a pair's hash in a token


def _let(value: Column, body) -> Column:
    """``body(value)``, with ``value`` computed once."""
    return F.transform(F.array(value), body)[0]


def _pack(high: Column, place: Column) -> Column:
    """``place`` in the low bits and the upper bits of ``high`` above."""
    kept = F.shiftright(high, _PLACE_BITS)
    return F.shiftleft(kept, _PLACE_BITS).bitwiseOR(place.cast("long"))


def _place(packed: Column) -> Column:
    return packed.bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))


def _run(packed: Column) -> Column:
    return F.shiftright(packed, _PLACE_BITS)


def _bin(packed: Column) -> Column:
    return F.shiftright(packed, 64 - _BIN_BITS)


def _runs(text: Column) -> Column:
    """(hash of the run, place) packed, for every run of ``K`` words. A text of fewer words,
    but some, is one run."""
    words = F.filter(F.split(text, r"[\s\x{85}\x{A0}]+"), lambda w: w != "")
    last = F.lit((1 << _PLACE_BITS) - 1)

    def of(w: Column) -> Column:
        hashed = F.transform(
            F.sequence(F.lit(0), F.size(w) - K),
            lambda i: _pack(F.xxhash64(*[F.get(w, i + k) for k in range(K)]), F.least(i, last)),
        )
        short = F.array(_pack(F.xxhash64(F.array_join(w, " ")), F.lit(0)))
        return F.when(F.size(w) >= K, hashed).when(F.size(w) > 0, short).otherwise(
            F.array().cast("array<bigint>")
        )

    return _let(words, of)


def _numbered(ordered: Column) -> Column:
    """Packed (bin, hash) of each run with its occurrence number, from sorted packed runs.

    Equal runs stand together, so the number is how far back the first of them is. It is
    found by doubling steps, for repeated runs only.
    """

    def of(s: Column) -> Column:
        def one(x: Column, i: Column) -> Column:
            equal = lambda back: F.coalesce(
                (back <= i) & (_run(F.get(s, i - back)) == _run(x)), F.lit(False)
            )
            steps = F.array(*[F.lit(1 << b) for b in range(_PLACE_BITS - 1, -1, -1)])
            far = F.aggregate(
                steps, F.lit(0), lambda d, step: F.when(equal(d + step), d + step).otherwise(d)
            )
            number = F.when(equal(F.lit(1)), far).otherwise(F.lit(0))
            return _pack(F.xxhash64(_run(x), number), _place(x))

        return F.transform(s, one)

    return _let(ordered, of)


def _pairs(ordered: Column) -> Column:
    """A token per filled bin, from sorted packed values: the bin and the hash of its pair."""

    def of(s: Column) -> Column:
        least = F.filter(
            s, lambda x, i: (i < 2) | F.coalesce(_bin(F.get(s, i - 2)) != _bin(x), F.lit(True))
        )

        def tokens(kept: Column) -> Column:
            def one(x: Column, i: Column) -> Column:
                first = (i == 0) | F.coalesce(_bin(F.get(kept, i - 1)) != _bin(x), F.lit(True))
                other = F.get(kept, i + 1)
                paired = F.coalesce(_bin(other) == _bin(x), F.lit(False))
                pair = (
                    F.when(~paired, F.xxhash64(_run(x)))
                    .when(_place(x) <= _place(other), F.xxhash64(_run(x), _run(other)))
                    .otherwise(F.xxhash64(_run(other), _run(x)))
                )
                number = F.shiftleft(_bin(x) + BINS // 2, _PAIR_BITS)
                token = number.bitwiseOR(F.shiftrightunsigned(pair, 64 - _PAIR_BITS)).cast("int")
                return F.when(first, token)

            return F.filter(F.transform(kept, one), lambda t: t.isNotNull())

        return _let(least, tokens)

    return _let(ordered, of)


def tokens(text: Column) -> Column:
    """The fingerprint of a text as an array of (bin, pair hash) in one int each, by bin."""
    return _pairs(F.sort_array(_numbered(F.sort_array(_runs(text)))))


def fingerprint(of: Column) -> Column:
    """The fingerprint as text: eight hexadecimal digits for each filled bin."""
    return F.array_join(F.transform(of, lambda t: F.lower(F.lpad(F.hex(t), 8, "0"))), "")


def likeness(a: Column, b: Column) -> Column:
    """The share of filled bins with the same pair; 1 for two texts without words."""

    def of(x: Column, y: Column) -> Column:
        bins = lambda t: F.transform(t, lambda v: F.shiftright(v, _PAIR_BITS))
        filled = F.size(F.array_union(bins(x), bins(y)))
        return F.when(filled == 0, 1.0).otherwise(F.size(F.array_intersect(x, y)) / filled)

    return _let(a, lambda x: _let(b, lambda y: of(x, y)))


def next_ids(docs: DataFrame) -> DataFrame:
    """(_prev, _next, need): every id and the one that follows it in ascending order, nulls first; the
    first follows the last; and a quarter of the length of the id's longest text. Ids are text here; a
    null id is a NUL.

    Each range of ids is ordered by its own task; only the first id of each is compared
    with the others'.
    """
    ids = docs.groupBy("doc_id").agg(F.max(F.floor(F.length("text") / 4)).cast("int").alias("need"))
    rows = placed(ids.withColumn("_id", _id(F.col("doc_id"))), [F.col("doc_id").asc_nulls_first()])
    order = F.struct(F.col("doc_id").isNotNull(), "doc_id")
    starts = rows.groupBy("_part").agg(F.min_by("_id", order).alias("first"))
    parts = Window.orderBy("_part")  # a row for each partition
    whole = parts.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    follows = starts.select(
        F.col("_part").alias("_at"),
        F.coalesce(F.lead("first").over(parts), F.first("first").over(whole)).alias("_next_first"),
    )
    inside = Window.partitionBy("_part").orderBy(F.col("doc_id").asc_nulls_first())
    return rows.withColumn("_lead", F.lead("_id").over(inside)).join(
        follows, F.col("_part") == F.col("_at")
    ).select(F.col("_id").alias("_prev"), "need", F.coalesce("_lead", "_next_first").alias("_next"))


def _id(doc_id: Column) -> Column:
    return F.coalesce(doc_id.cast("string"), F.lit("\x00"))


def compare_with_edit(docs: DataFrame) -> DataFrame:
    """Each document's fingerprint, that of its edited text, and likenesses.

    The edited text has its last quarter replaced by the first as many characters of the
    next document. Null texts read as empty. Of several rows with the id that comes next, the
    next document is the one whose beginning sorts first; a single id is its own next.
    Repeated rows give repeated results.
    """
    kind = docs.schema["doc_id"].dataType
    texts = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = texts.select(_id(F.col("doc_id")).alias("_id"), "text", tokens(F.col("text")).alias("tokens"))
    # Both joins below deal the same rows out by id, so Spark moves the texts once.
    heads = rows.join(next_ids(texts), F.col("_id") == F.col("_next")).select(
        "_prev", F.struct(F.expr("left(text, need)").alias("head"), "tokens").alias("first")
    )
    following = heads.groupBy("_prev").agg(F.min("first").alias("first")).select(
        "_prev", F.col("first.head").alias("_head"), F.col("first.tokens").alias("_next_tokens")
    )
    n = F.length("text")
    quarter = F.floor(n / 4).cast("int")
    edited = F.concat(F.expr("left(text, length(text) - cast(floor(length(text) / 4) as int))"),
                      F.left("_head", quarter))
    both = rows.join(following, F.col("_id") == F.col("_prev")).select(
        F.nullif(F.col("_id"), F.lit("\x00")).cast(kind).alias("doc_id"), n.cast("long").alias("n_chars"),
        "tokens", "_next_tokens", edited.alias("_edited"),
    )
    both = both.select(
        "doc_id", "n_chars", "tokens", "_next_tokens",
        F.sha2("_edited", 256).alias("edited_sha256"), tokens(F.col("_edited")).alias("_edited_tokens"),
    )
    return both.select(
        "doc_id", "n_chars", "edited_sha256",
        fingerprint(F.col("tokens")).alias("fingerprint"),
        fingerprint(F.col("_edited_tokens")).alias("edited_fingerprint"),
        likeness(F.col("tokens"), F.col("_edited_tokens")).alias("near_edited"),
        likeness(F.col("tokens"), F.col("_next_tokens")).alias("near_next"),
    )
