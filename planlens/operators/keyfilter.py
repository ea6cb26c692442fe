"""A Bloom filter of bounded size, so that rows without a listed key skip a shuffle.

It holds at most ``MAX_BITS`` bits however many keys there are, so it may be broadcast. More
keys let more other rows pass, in the end all of them: results never rest on it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_BITS = 1 << 27  # 16 MB of bits
_PER_KEY = 16  # bits for each key: two places of 16 pass one in 70 other rows
_WORDS = 1 << 10  # 64-bit words in a row of the table


def bits_for(keys: int) -> int:
    """A power of two, at least a row of the table and at most ``MAX_BITS``."""
    bits = 64 * _WORDS
    while bits < min(_PER_KEY * keys, MAX_BITS):
        bits *= 2
    return bits


def _places(key: Column, bits: int) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(bits)) for seed in ("first", "second")]


def key_filter(keys: DataFrame, key: str, bits: int) -> DataFrame:
    """(block, words): the set bits of the places of every key."""
    places = keys.select(F.explode(F.array(*_places(F.col(key), bits))).alias("place"))
    word = F.shiftright("place", 6)
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("place") % 64).cast("int"))
    words = places.groupBy(word.alias("word")).agg(F.bit_or(bit).alias("set"))
    block = words.groupBy(F.floor(F.col("word") / _WORDS).cast("int").alias("block")).agg(
        F.map_from_entries(F.collect_list(F.struct((F.col("word") % _WORDS).cast("int"), "set"))).alias("at")
    )
    # A block has _WORDS words at most, so the list is bounded.
    return block.select("block", F.transform(
        F.sequence(F.lit(0), F.lit(_WORDS - 1)), lambda k: F.coalesce(F.try_element_at("at", k), F.lit(0).cast("long"))
    ).alias("words"))


def maybe_listed(df: DataFrame, key: Column, listed: DataFrame, bits: int, name: str) -> DataFrame:
    """``df`` with a boolean ``name``, false only where ``key`` is not in ``listed``, the
    result of ``key_filter``. No row moves."""
    for n, place in enumerate(_places(key, bits)):
        block = F.floor(F.shiftright(place, 6) / _WORDS).cast("int")
        words = F.broadcast(listed.select(F.col("block").alias(f"_block{n}"), F.col("words").alias(f"_words{n}")))
        df = df.join(words, block == F.col(f"_block{n}"), "left")
    hits = []
    for n, place in enumerate(_places(key, bits)):
        word = F.get(f"_words{n}", (F.shiftright(place, 6) % _WORDS).cast("int"))
        hits.append(F.coalesce(F.bit_get(word, (place % 64).cast("int")) == 1, F.lit(False)))
    return df.withColumn(name, hits[0] & hits[1]).drop("_block0", "_words0", "_block1", "_words1")
