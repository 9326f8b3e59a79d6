"""Null-safe joins on grouping keys, and splits of rows by a set of keys of any size."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendscope.session import stored

#: Bits of a filter for each key, and in all: at most 2**20 rows of 64 bits, or 16 MB, are broadcast.
BITS_EACH, MOST_BITS = 16, 26


def attach(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Join ``right`` (at most one row per key) to ``left``, matching NULL with NULL.

    No side is hinted for broadcast: adaptive execution does that once it has seen the size.
    """
    renamed = right.withColumnsRenamed({k: f"__{k}" for k in keys})
    match = reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys))
    return left.join(renamed, match, how).drop(*(f"__{k}" for k in keys))


def _is_large(df: DataFrame) -> bool:
    """Whether ``df`` is a table of known size that is too large to go to every task.

    What is still to be computed has no size yet; adaptive execution decides about it later.
    """
    plan = df._jdf.queryExecution().optimizedPlan()
    if not plan.children().isEmpty() or "InMemory" in plan.nodeName():
        return False
    limit = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return int(str(plan.stats().sizeInBytes())) > limit


def _slot(key: Column, bits: int) -> Column:
    return F.xxhash64(key).bitwiseAND(F.lit((1 << bits) - 1))


def member_filter(members: DataFrame, key: str) -> tuple[DataFrame, int]:
    """A Bloom filter of the keys with one hash: rows (__word, __mask), and its number of bits as a power of 2.

    Its size is set by the number of keys up to a bound; a fuller filter only lets more rows through.
    """
    bits = min(max(10, (BITS_EACH * members.count()).bit_length()), MOST_BITS)
    slot = _slot(F.col(key), bits)
    bit = F.expr("shiftleft(1L, cast(slot & 63 as int))")
    words = members.select(slot.alias("slot")).select(F.shiftright("slot", 6).alias("__word"), bit.alias("bit"))
    return stored(words.groupBy("__word").agg(F.bit_or("bit").alias("__mask")), "member-filter"), bits


def _possible(df: DataFrame, key: str, found: tuple[DataFrame, int]) -> DataFrame:
    """``df`` with ``__possible``, which is False only where the key is certainly no member."""
    words, bits = found
    slot = _slot(F.col(key), bits)
    joined = df.withColumn("__slot", slot).join(F.broadcast(words), F.shiftright("__slot", 6) == F.col("__word"), "left")
    bit = F.expr("shiftleft(1L, cast(__slot & 63 as int))")
    return joined.withColumn("__possible", F.coalesce(F.col("__mask").bitwiseAND(bit) != 0, F.lit(False)))


def rows_of(df: DataFrame, members: DataFrame, key: str) -> DataFrame:
    """The rows whose key is in ``members`` (distinct keys).

    A table too large for a broadcast is folded into a filter first, so that most other rows are
    not shuffled for the join.
    """
    if not _is_large(members):
        return df.join(members, key, "left_semi")
    likely = _possible(df, key, member_filter(members, key)).where("__possible")
    return likely.select(*df.columns).join(members, key, "left_semi")


def rows_without(df: DataFrame, members: DataFrame, key: str) -> DataFrame:
    """The other rows, those without a key too."""
    if not _is_large(members):
        return df.join(members, key, "left_anti")
    marked = _possible(df, key, member_filter(members, key))
    unsure = marked.where("__possible").select(*df.columns).join(members, key, "left_anti")
    return marked.where("not __possible").select(*df.columns).unionByName(unsure)
