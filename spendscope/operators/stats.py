"""Statistics by category, hour and state, and a profile of the input columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendscope.functions import DISTANCE_DECIMALS, exact_deviation, mean, units
from spendscope.operators.joins import attach
from spendscope.operators.quantiles import range_quantile, value_ranges
from spendscope.operators.sketches import LG_K, estimate
from spendscope.params import Params


def _users(params: Params) -> Column:
    if params.distinct == "exact":
        return F.count_distinct("cc_num")
    return estimate(F.hll_sketch_agg("cc_num", LG_K))


def category_stats(df: DataFrame, params: Params = Params()) -> DataFrame:
    """Transactions, users and average amount per category, most frequent first."""
    return (
        df.groupBy("category")
        .agg(
            F.count("trans_num").alias("total_transactions"),
            _users(params).alias("unique_users"),
            mean(F.col("amt"), params.amount_decimals).alias("avg_amount"),
        )
        .orderBy(F.desc("total_transactions"), F.asc("category"))
    )


def category_stats_extended(df: DataFrame, params: Params = Params(), digits: int = 4) -> DataFrame:
    """``category_stats`` with median, standard deviation and mean distance, rounded half-even."""
    counts = df.groupBy("category").agg(
        F.count("trans_num").alias("total_transactions"),
        _users(params).alias("unique_users"),
        mean(F.col("amt"), params.amount_decimals).alias("avg_amount"),
    )
    return extend_category_stats(counts, category_amounts(df, params), params, digits)


def category_amounts(df: DataFrame, params: Params = Params()) -> DataFrame:
    """How often each amount occurs in a category, with the distances: small for amounts of money.

    It is what the median, the deviation and the mean distance are made of. With exact sums
    distances are added up in whole units.
    """
    distance = F.col("geo_distance_km")
    if params.amount_decimals is not None:
        distance = units(distance, DISTANCE_DECIMALS)
    return df.groupBy("category", F.col("amt").cast("double").alias("amt")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(distance).alias("distance"), F.count(distance).alias("distances")
    )


def extend_category_stats(
    counts: DataFrame, amounts: DataFrame, params: Params = Params(), digits: int = 4
) -> DataFrame:
    """``category_stats`` with the columns that ``category_amounts`` adds, rounded half-even.

    The amounts are written once, in ranges; median, deviation and mean distance start from there.
    With exact sums the deviation is one aggregate; else it is that of the amounts from their
    mean, added up in one more pass over the counts.
    """
    ranges = value_ranges(amounts, "amt", ["category"], count="n")
    distance = F.try_divide(F.sum("distance").cast("double"), F.sum("distances"))
    if params.amount_decimals is not None:
        deviation = exact_deviation(F.col("amt"), params.amount_decimals, F.col("n")).alias("std_amount")
        scale = float(10**DISTANCE_DECIMALS)
        more = ranges.groupBy("category").agg((distance / scale).alias("avg_distance"), deviation)
    else:
        more = _centred_deviation(ranges, ranges.groupBy("category").agg(distance.alias("avg_distance"), *_weighted_mean()))
    median = range_quantile(ranges, 0.5, ["category"], "interpolated", "median_amount")
    joined = attach(attach(counts, more, ["category"]), median, ["category"])
    rounded = ("avg_amount", "median_amount", "std_amount", "avg_distance")
    return joined.select(
        "category",
        "total_transactions",
        "unique_users",
        *(F.bround(c, digits).alias(c) for c in rounded),
    ).orderBy(F.desc("total_transactions"), F.asc("category"))


def _weighted_mean() -> list[Column]:
    weight = F.when(F.col("amt").isNotNull(), F.col("n"))
    mean_amount = F.try_divide(F.sum(F.col("amt") * F.col("n")), F.sum(weight))
    return [mean_amount.alias("mean_amount"), F.sum(weight).alias("known")]


def _centred_deviation(amounts: DataFrame, means: DataFrame) -> DataFrame:
    off = F.col("amt") - F.col("mean_amount")
    squares = attach(amounts, means.select("category", "mean_amount"), ["category"]).groupBy("category").agg(
        F.sum(off * off * F.col("n")).alias("squares")
    )
    deviation = F.when(F.col("known") > 1, F.sqrt(F.col("squares") / (F.col("known") - 1)))
    return attach(means, squares, ["category"]).select("category", "avg_distance", deviation.alias("std_amount"))


def hourly_stats(df: DataFrame, params: Params = Params()) -> DataFrame:
    return df.groupBy("hour").agg(
        F.count("trans_num").alias("transaction_count"),
        mean(F.col("amt"), params.amount_decimals).alias("avg_amount"),
        _users(params).alias("unique_users"),
    )


def state_stats(df: DataFrame, params: Params = Params()) -> DataFrame | None:
    """``None`` when the input has no ``state`` column."""
    if "state" not in df.columns:
        return None
    return df.groupBy("state").agg(
        F.count("trans_num").alias("transaction_count"),
        mean(F.col("amt"), params.amount_decimals).alias("avg_amount"),
    )


def basic_stats(
    df: DataFrame, params: Params = Params()
) -> tuple[DataFrame, DataFrame, DataFrame | None]:
    """Extended category statistics, hourly statistics, and state statistics if there are states."""
    return category_stats_extended(df, params), hourly_stats(df, params), state_stats(df, params)


def amount_bin_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("amount_bin").agg(F.count(F.lit(1)).alias("transactions"))


def top_categories(stats: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` most frequent categories; empty for empty input."""
    return stats.orderBy(F.desc("total_transactions"), F.asc("category")).limit(n)


def busiest_hour(stats: DataFrame) -> DataFrame:
    """The hour with the most transactions, the earliest one on a tie, and its count."""
    return (
        stats.orderBy(F.desc("transaction_count"), F.asc("hour"))
        .limit(1)
        .select(F.col("hour").alias("peak_hour"), F.col("transaction_count"))
    )


def table_shape(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.lit(len(df.columns)).cast("int").alias("column_count"),
    )


def preview(df: DataFrame, n: int = 5, order: str | None = None) -> DataFrame:
    """The first ``n`` rows by ``order``; without it, which ones is up to the scan."""
    return (df.orderBy(order) if order else df).limit(n)


def column_profile(df: DataFrame) -> DataFrame:
    """One row per column: its type, the row count and how many values are missing.

    All columns are counted in a single pass; NaN counts as missing.
    """
    fields = df.schema.fields

    def missing(field: T.StructField):
        c = F.col(f"`{field.name}`")
        gone = c.isNull()
        if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            gone = gone | F.isnan(c)
        return F.count_if(gone)

    counts = df.agg(
        F.count(F.lit(1)).alias("row_count"),
        *(missing(f).alias(f"missing_{i}") for i, f in enumerate(fields)),
    )
    entries = (
        F.struct(
            F.lit(f.name).alias("column_name"),
            F.lit(f.dataType.simpleString()).alias("data_type"),
            F.col("row_count"),
            F.col(f"missing_{i}").alias("missing"),
        )
        for i, f in enumerate(fields)
    )
    return counts.select(F.inline(F.array(*entries)))


def missing_values(profile: DataFrame) -> DataFrame:
    """Only the columns that miss values."""
    return profile.where(F.col("missing") > 0).select("column_name", "missing")


def type_counts(profile: DataFrame) -> DataFrame:
    """Number of columns per data type."""
    return profile.groupBy("data_type").agg(F.count(F.lit(1)).alias("columns"))


def null_out(df: DataFrame, values: dict[str, object]) -> DataFrame:
    """Replace one marker value per column by NULL."""
    return reduce(
        lambda d, kv: d.withColumn(kv[0], F.nullif(F.col(kv[0]), F.lit(kv[1]))), values.items(), df
    )
