"""Picking out the few rows of a large table that belong to a set of keys, without shuffling it.

The set is folded into a bitmap of a number of bits with a fixed bound, which is broadcast: its size
does not grow with the data beyond that. A row whose bit is not set is certainly outside the set; one whose bit
is set is nearly always inside, and what follows settles that exactly. If a set is much larger
than the bitmap, more rows take the exact way behind it and results stay the same.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: 2**24 bits as 64-bit words: at most 262,144 rows of 16 bytes.
BITS = 24
#: Where the number of keys is known: 16 bits for each, 2**27 bits or 32 MB at most.
MOST_BITS = 27


def bits_for(keys: DataFrame) -> int:
    """Size of a bitmap for the rows of ``keys``, a stored table."""
    return min(max(BITS, (16 * keys.count()).bit_length()), MOST_BITS)


def _slot(key: Column, bits: int) -> Column:
    return F.xxhash64(key).bitwiseAND(F.lit((1 << bits) - 1))


def bitmap(keys: DataFrame, key: Column, bits: int = BITS) -> DataFrame:
    """``keys`` as rows (word, mask); no more than ``2 ** (bits - 6)`` of them."""
    slot = _slot(key, bits)
    return (
        keys.select(slot.alias("slot"))
        .select(F.shiftright("slot", 6).alias("__bit_word"), F.expr("shiftleft(1L, cast(slot & 63 as int))").alias("bit"))
        .groupBy("__bit_word")
        .agg(F.bit_or("bit").alias("__bit_mask"))
    )


def marked(df: DataFrame, key: Column, bits_set: DataFrame, name: str, bits: int = BITS) -> DataFrame:
    """``df`` with a boolean column that is False only for rows certainly outside the set."""
    slot = _slot(key, bits)
    found = df.withColumn("__slot", slot).join(
        F.broadcast(bits_set), F.shiftright("__slot", 6) == F.col("__bit_word"), "left"
    )
    bit = F.expr("shiftleft(1L, cast(__slot & 63 as int))")
    hit = F.coalesce(F.col("__bit_mask").bitwiseAND(bit) != 0, F.lit(False))
    return found.withColumn(name, hit).drop("__slot", "__bit_word", "__bit_mask")
