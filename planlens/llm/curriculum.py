"""Mixing sources to target weights along a time-varying curriculum.

Every source has a weight schedule over training time t in [0, 1],
``w(t) = weight * (1 + slope * (2t - 1))``, whose integral is its weight. Shares are cut so
that no source is repeated more than ``max_repeats`` times. A source's documents, in an
order that only depends on their ids, form a stream of words, repeated as often as its
target asks; the word at place ``d`` of that stream is due at the time when the
source's cumulative demand ``target * (t + slope * (t*t - t))`` reaches ``d``.

DataFrame functions only.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from planlens.llm.ordering import placed, running_totals
from planlens.session import settle

WEIGHTS = (3, 1, 2)  # by source in code point order, repeating
SLOPES = (0.5, 0.0, -0.5)  # the same: later, even, earlier in training
SHARE = 1.5  # words of the mix, of all words
MAX_REPEATS = 2.0


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _cycle(values: Sequence[float], rank: Column) -> Column:
    return F.element_at(
        F.array(*[F.lit(float(v)) for v in values]), (rank % len(values) + 1).cast("int")
    )


def source_targets(
    sizes: DataFrame,
    *,
    weights: Sequence[float] = WEIGHTS,
    slopes: Sequence[float] = SLOPES,
    share: float = SHARE,
    max_repeats: float = MAX_REPEATS,
) -> DataFrame:
    """(source, source_size) to (source, source_size, slope, target).

    Sharing by weight and resharing what exceeds a cap, until none does, ends where each
    target is ``min(cap, level * weight)`` with one level for all. Sources by cap per
    weight: the level is where those before are at their caps and this one is not.
    """
    ordered = placed(
        sizes.withColumn("_last", F.col("source").isNull()).withColumn("_one", F.lit(1)),
        ["_last", "source"],
    )
    ranked = running_totals(ordered, [], ["_last", "source"], {"_rank": "_one"})
    capped = ranked.select(
        "source", "source_size",
        _cycle(slopes, F.col("_rank")).alias("slope"),
        _cycle(weights, F.col("_rank")).alias("_weight"),
        (F.col("source_size") * max_repeats).alias("_cap"),
    ).withColumn("_ratio", F.col("_cap") / F.col("_weight"))
    by_ratio = placed(capped, ["_ratio", "source"])
    budget = by_ratio.agg(F.sum("source_size") * share).scalar()
    all_weight = by_ratio.agg(F.sum("_weight")).scalar()
    filled = running_totals(
        by_ratio, [], ["_ratio", "source"], {"_caps": "_cap", "_weights": "_weight"}
    )
    levels = filled.select(
        "_ratio", ((budget - F.col("_caps")) / (all_weight - F.col("_weights"))).alias("_level")
    )
    level = (
        levels.where(F.col("_level") <= F.col("_ratio"))
        .agg(F.min_by("_level", "_ratio")).scalar()
    )
    return by_ratio.select(
        "source", "source_size", "slope",
        F.round(F.least("_cap", level * F.col("_weight")), 6).alias("target"),
    )


def time_due(demand: Column, target: Column, slope: Column) -> Column:
    """The time at which a source's cumulative demand reaches ``demand`` words; null for a
    source without words, which has no target."""
    y = F.try_divide(demand, target)
    rest = 1 - slope
    return 2 * y / (rest + F.sqrt(rest * rest + 4 * slope * y))


def place_documents(docs: DataFrame, **schedule) -> DataFrame:
    """Which words of each document the mix takes, and when.

    ``docs`` has doc_id, source, size and any columns but those added: source_size, slope,
    target, taken, and copies, an array of (words, position) per repetition. The last
    document of a source is cut at the word where its target ends, so a source's words are
    its target without the fraction.

    Null sources form one source, the last. Sizes of 0 are taken 0 times, and so is a source
    of only such documents. Repeated rows are documents of their own. An empty table gives an
    empty table.
    """
    docs = settle(docs)  # the bounds of the ranges take a pass of their own
    key = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    order = ["_key", "doc_id", *[c for c in docs.columns if c not in ("doc_id", "source")]]
    rows = placed(docs.withColumn("_key", key), ["source", "_key", "doc_id"])
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = source_targets(sizes, **schedule).withColumnRenamed("source", "_source")
    begun = running_totals(rows, ["source"], order, {"_begin": "size"})
    rows = begun.join(targets, F.col("source").eqNullSafe(F.col("_source")))

    repeats = math.ceil(schedule.get("max_repeats", MAX_REPEATS))
    words = F.floor("target")

    def copy(k: Column) -> Column:
        start = F.col("_begin") + k * F.col("source_size")
        part = F.greatest(F.lit(0), F.least(F.col("size"), words - start))
        due = time_due(start + part / 2, F.col("target"), F.col("slope"))
        return F.struct(part.cast("long").alias("words"), F.round(due, 9).alias("position"))

    copies = F.filter(
        F.transform(F.sequence(F.lit(0), F.lit(repeats - 1)), copy), lambda c: c["words"] > 0
    )
    taken = F.aggregate("copies", F.lit(0).cast("long"), lambda n, c: n + c["words"])
    return rows.withColumn("copies", copies).withColumn("taken", taken).select(
        *docs.columns, "source_size", "slope", "target", "taken", "copies"
    )


def mix(docs: DataFrame, **schedule) -> DataFrame:
    """The training stream: a row per document and repetition, sorted by position.

    Returns the columns of ``docs`` plus mix_words (words of the text that the mix takes),
    mix_copy (from 0) and mix_position, which replace columns of those names. Documents
    that the mix doesn't take are left out. Rows with the same doc_id, source and text are
    told apart by number only.
    """
    added = ("mix_words", "mix_copy", "mix_position")
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("\x02"))
    identity = F.md5(F.concat_ws("\x01", blank("doc_id"), blank("source"), blank("text")))
    small = docs.select(
        "doc_id", "source", word_count(F.col("text")).alias("size"), identity.alias("_row")
    )
    keyed = docs.select(
        F.struct(*[c for c in docs.columns if c.lower() not in added]).alias("row"),
        identity.alias("_row"),
    )
    plans = place_documents(small, **schedule).groupBy("_row").agg(
        F.collect_list("copies").alias("_plans")
    )
    same = Window.partitionBy("_row").orderBy("_row")
    numbered = keyed.withColumn("_nth", F.row_number().over(same))
    copies = F.posexplode(F.element_at("_plans", F.col("_nth"))).alias("mix_copy", "_copy")
    return (
        numbered.join(plans, "_row")
        .select("row", copies)
        .select(
            "row.*", F.col("_copy.words").alias("mix_words"), "mix_copy",
            F.col("_copy.position").alias("mix_position"),
        )
        .repartitionByRange("mix_position", "doc_id")
        .sortWithinPartitions("mix_position", "doc_id")
    )
