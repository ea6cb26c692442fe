"""A Bloom filter of fixed size, as a table of 64-bit words.

It is ``BITS`` bits however many keys it holds, so it may be broadcast. With more keys more
other rows pass, in the end all of them: it only saves work, and results don't rest on it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 1 << 24  # 2 MB of bits, in 262,144 rows


def _place(key: Column) -> Column:
    return F.pmod(F.xxhash64(key, F.lit("bloom")), F.lit(BITS))


def marked(docs: DataFrame, key: Column, keys: DataFrame, name: str) -> DataFrame:
    """``docs`` with a boolean column ``name``: false only where ``key`` isn't among
    ``keys``, a table of one column."""
    place = _place(F.col(keys.columns[0]))
    bits = keys.groupBy(F.shiftright(place, 6).cast("int").alias("_word")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), (place % 64).cast("int"))).alias("_bits")
    )
    at = _place(key)
    hit = F.coalesce(F.bit_get("_bits", (at % 64).cast("int")) == 1, F.lit(False))
    same = F.shiftright(at, 6).cast("int") == F.col("_word")
    return docs.join(F.broadcast(bits), same, "left").select(*docs.columns, hit.alias(name))
