"""Mergeable summaries for very large inputs: distinct users or values, and quantiles.

Exact results stay the default everywhere. A sketch has a fixed size however many rows went in,
is combined on the map side, and can be kept: those of several days, sources or runs are merged
into that of all of them without reading a row again. Distinct counts use HyperLogLog sketches,
quantiles use KLL sketches; both are Spark's own aggregates.

The stated errors: a distinct count is off by more than ``distinct_error`` (relative) with a
probability of about 0.3 % (three standard errors); the rank of a quantile is off by more than
``rank_error`` (as a share of the rows) with one of 1 %. Small counts are nearly exact.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendscope.functions import exact_amount
from spendscope.params import Params

#: Registers of a distinct sketch: 2**12, at most 2 to 3 KB. Spark allows 4 to 21.
LG_K = 12
#: Size of a quantile sketch: about 0.6 % rank error in some 10 KB. Spark allows 8 to 65,535.
QUANTILE_K = 800

_SUMS = ("n", "transactions", "amount", "amounts")


def distinct_error(lg_k: int = LG_K) -> float:
    """Three relative standard errors of a merged distinct count."""
    return 3 * 1.04 / math.sqrt(1 << lg_k)


def rank_error(k: int = QUANTILE_K) -> float:
    """The rank error of a quantile that 99 of 100 sketches keep to."""
    # The published fit of the error to the sketch's size.
    return 2.296 / k**0.9021


def estimate(sketch: str | Column) -> Column:
    """The distinct count of a sketch, as a whole number."""
    return F.hll_sketch_estimate(sketch)


def _union(tables: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, tables)


def dimension_sketches(
    df: DataFrame, dimensions: Sequence[str], params: Params = Params(), lg_k: int = LG_K
) -> DataFrame:
    """One row per value of each dimension: what ``user_dimension_totals`` sums up, and a sketch of the users.

    Columns ``dimension``, ``value`` (as text), ``n`` rows, ``transactions`` with an id, ``amount``,
    ``amounts`` and ``users``. Its size doesn't depend on the number of users. NULL users don't count.
    """
    amount = exact_amount(F.col("amt"), params.amount_decimals).alias("amt")
    narrow = df.select("cc_num", "trans_num", amount, *(F.col(d).cast("string").alias(d) for d in dimensions))
    return (
        narrow.unpivot(["cc_num", "trans_num", "amt"], list(dimensions), "dimension", "value")
        .groupBy("dimension", "value")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count("trans_num").alias("transactions"),
            F.sum("amt").alias("amount"),
            F.count("amt").alias("amounts"),
            F.hll_sketch_agg("cc_num", lg_k).alias("users"),
        )
    )


def merge_dimension_sketches(*tables: DataFrame) -> DataFrame:
    """The sketches of all inputs together, from the ``dimension_sketches`` of each.

    Sketches of different sizes are merged into the smallest.
    """
    return (
        _union(tables)
        .groupBy("dimension", "value")
        .agg(*(F.sum(c).alias(c) for c in _SUMS), F.hll_union_agg("users", True).alias("users"))
    )


def sketched_stats(sketches: DataFrame, dimension: str, count_name: str) -> DataFrame:
    """Count, average amount and estimated users per value; the columns of ``dimension_stats``."""
    return sketches.where(F.col("dimension") == dimension).select(
        F.col("value").alias(dimension),
        F.col("transactions").alias(count_name),
        F.try_divide(F.col("amount").cast("double"), F.col("amounts")).alias("avg_amount"),
        estimate("users").alias("unique_users"),
    )


def user_sketches(df: DataFrame, facets: Sequence[str] = ("category", "merchant"), lg_k: int = LG_K) -> DataFrame:
    """One row per user with a sketch of each facet's values: columns ``cc_num`` and the facets."""
    return df.groupBy("cc_num").agg(*(F.hll_sketch_agg(F.col(f).cast("string"), lg_k).alias(f) for f in facets))


def merge_user_sketches(*tables: DataFrame) -> DataFrame:
    facets = [c for c in tables[0].columns if c != "cc_num"]
    return _union(tables).groupBy("cc_num").agg(*(F.hll_union_agg(f, True).alias(f) for f in facets))


def sketched_facets(sketches: DataFrame) -> DataFrame:
    """Estimated distinct values per user: ``unique_categories``, ``unique_merchants`` and the like."""
    plural = {"category": "categories", "merchant": "merchants"}
    return sketches.select(
        "cc_num", *(estimate(f).alias(f"unique_{plural.get(f, f)}") for f in sketches.columns if f != "cc_num")
    )


def value_sketches(df: DataFrame, value: str, keys: Sequence[str] = (), k: int = QUANTILE_K) -> DataFrame:
    """One row per group with a sketch of its values (column ``sketch``); NULL and NaN are skipped.

    Groups without values are there, with an empty sketch. No value is shuffled, only sketches.
    """
    v = F.col(value).cast("double")
    return df.groupBy(*keys).agg(F.kll_sketch_agg_double(F.when(~F.isnan(v), v), k).alias("sketch"))


def merge_value_sketches(*tables: DataFrame) -> DataFrame:
    keys = [c for c in tables[0].columns if c != "sketch"]
    return _union(tables).groupBy(*keys).agg(F.kll_merge_agg_double("sketch").alias("sketch"))


def sketched_quantile(sketches: DataFrame, p: float, name: str = "threshold") -> DataFrame:
    """The ``p`` quantile of each sketch, one of its values; NULL where there are none."""
    keys = [c for c in sketches.columns if c != "sketch"]
    some = F.kll_sketch_get_n_double("sketch") > 0
    return sketches.select(*keys, F.when(some, F.kll_sketch_get_quantile_double("sketch", F.lit(float(p)))).alias(name))
