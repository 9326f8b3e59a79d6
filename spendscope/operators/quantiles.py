"""Exact quantiles that never gather a group in one task.

The built-in exact percentile keeps every distinct value of a group in one buffer. Here the
values are counted and range-partitioned by group and value, the only shuffle they take, and
written with the number of their partition. One small row per group and partition then tells
which partition holds the wanted rank, and only that one is looked into. However many values a
group has, they spread over partitions of equal size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spendscope.operators.joins import attach
from spendscope.session import stored

_RANKS = ("low_rank", "high_rank", "weight")
_OWN = ("__value", "__rows", "__part")


def value_ranges(df: DataFrame, value: str, keys: Sequence[str] = (), count: str | None = None) -> DataFrame:
    """The values in ranges, as a scratch table for ``range_quantile``; this runs a job.

    Without ``count``, equal values of a group become one row first, on the map side, so a frequent
    one is no burden. ``count`` names a column that says how often a row counts; then rows are
    taken as they are, with all their columns, and each should stand for one value.
    """
    v = F.col(value).cast("double")
    known = v.isNotNull() & ~F.isnan(v)
    if count is None:
        rows = df.select(*keys, v.alias("__value")).where(known).groupBy(*keys, "__value").agg(F.count(F.lit(1)).alias("__rows"))
    else:
        # Rows without a value stay for their other columns, and count 0.
        rows = df.withColumns({"__value": v, "__rows": F.when(known, F.col(count)).otherwise(0).cast("bigint")})
    ranged = rows.repartitionByRange(*keys, "__value")
    return stored(ranged.withColumn("__part", F.spark_partition_id()), "value-ranges")


def range_quantile(
    ranges: DataFrame, p: float, keys: Sequence[str] = (), method: str = "rank", name: str = "threshold"
) -> DataFrame:
    """One row per group with the ``p`` quantile of the values in ``value_ranges``."""
    keys = list(keys)
    sizes = ranges.groupBy(*keys, "__part").agg(F.sum("__rows").alias("rows"))
    # One row per group and partition that it reaches.
    by_group = Window.partitionBy(*keys)
    upto, n = F.sum("rows").over(by_group.orderBy("__part")), F.sum("rows").over(by_group)
    placed = sizes.select(*keys, "__part", (upto - F.col("rows")).alias("before"), upto.alias("upto"), *_ranks(n, p, method))
    low, high = F.col("low_rank"), F.col("high_rank")
    holding = placed.where(_holds(F.col("before"), F.col("upto"), low) | _holds(F.col("before"), F.col("upto"), high))
    inside = attach(ranges.select(*keys, *_OWN), holding.drop("upto"), [*keys, "__part"], "inner")
    within = Window.partitionBy(*keys, "__part").orderBy("__value").rowsBetween(Window.unboundedPreceding, 0)
    after = F.col("before") + F.sum("__rows").over(within)
    found = inside.withColumn("after", after).withColumn("ahead", F.col("after") - F.col("__rows"))
    # Without keys and values, the aggregate still yields a row.
    ends = found.groupBy(*keys).agg(
        *(F.max(F.when(_holds(F.col("ahead"), F.col("after"), r), F.col("__value"))).alias(e) for e, r in (("low", low), ("high", high))),
        F.first("weight").alias("weight"),
    )
    return ends.select(*keys, _blend(F.col("low"), F.col("high")).alias(name))


def exact_quantile(
    df: DataFrame,
    value: str,
    p: float,
    keys: Sequence[str] = (),
    method: str = "rank",
    name: str = "threshold",
    count: str | None = None,
) -> DataFrame:
    """One row per group with the ``p`` quantile of ``value``; NULL and NaN are skipped.

    ``method='rank'`` takes the value at rank ceil(p * n); ``'interpolated'`` interpolates
    between the two values around position p * (n - 1). Without ``keys`` the result is one
    row, holding NULL when there are no values. Groups without values are absent. ``count``
    names a column that says how often a row counts. The values are written to a scratch table.
    """
    _ranks(F.lit(1), p, method)
    return range_quantile(value_ranges(df, value, keys, count), p, keys, method, name)


def _holds(before: Column, upto: Column, rank: Column) -> Column:
    return (before < rank) & (rank <= upto)


def _ranks(n: Column, p: float, method: str) -> list[Column]:
    if method == "rank":
        low = high = F.greatest(F.ceil(F.lit(p) * n).cast("bigint"), F.lit(1).cast("bigint"))
        weight = F.lit(0.0)
    elif method == "interpolated":
        position = F.lit(p) * (n - 1)
        low, high = F.floor(position).cast("bigint") + 1, F.ceil(position).cast("bigint") + 1
        weight = position - F.floor(position)
    else:
        raise ValueError("method must be 'rank' or 'interpolated'")
    return [c.alias(a) for c, a in zip((low, high, weight), _RANKS)]


def _blend(low: Column, high: Column) -> Column:
    weight = F.col("weight")
    # At weight 0 the two ranks are the same one, and infinite values must not turn into NaN.
    return F.when(weight == 0, low).otherwise(low * (1 - weight) + high * weight)
