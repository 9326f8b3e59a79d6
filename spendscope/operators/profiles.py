"""One behavioural profile per user.

A user may own a large share of all rows, so nothing gathers a user's rows: sums, extremes
and deviations are combined on the map side, and distinct values are counted by grouping on
the value first. The user-level tables that result hold one row per user, partitioned by
user, whatever the number of transactions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spendscope.functions import (
    DISTANCE_DECIMALS,
    exact_deviation,
    exact_mean,
    exact_span_days,
    guarded_rate,
    is_local,
    mean,
    total,
    whole_span_days,
)
from spendscope.operators.joins import attach
from spendscope.operators.usertotals import user_dimension_totals
from spendscope.params import Params

FACETS = ("category", "merchant", "hour")
PROFILE_COLUMNS = (
    "cc_num",
    "total_transactions",
    "total_spent",
    "avg_transaction",
    "std_transaction",
    "unique_categories",
    "unique_merchants",
    "first_transaction",
    "last_transaction",
    "avg_geo_distance",
    "activity_span_days",
    "transactions_per_day",
    "peak_hour",
    "avg_distance",
    "max_distance",
    "std_distance",
)


def _distances(params: Params) -> list[Column]:
    """Mean, largest and deviation of the distances; with exact sums if the amounts have them."""
    km, decimals = F.col("geo_distance_km"), None if params.amount_decimals is None else DISTANCE_DECIMALS
    return [
        exact_mean(km, decimals).alias("avg_distance"),
        F.max(km).alias("max_distance"),
        exact_deviation(km, decimals).alias("std_distance"),
    ]


def user_totals(df: DataFrame, params: Params = Params()) -> DataFrame:
    """Counts, amounts, activity span and rate per user: one shuffle, combined on the map side."""
    first, last = F.col("first_transaction"), F.col("last_transaction")
    if params.span == "days":
        span = whole_span_days(first, last)
    else:
        span = exact_span_days(first, last, is_local(df, "trans_date_trans_time"))
    return (
        df.groupBy("cc_num")
        .agg(
            F.count("trans_num").alias("total_transactions"),
            total(F.col("amt"), params.amount_decimals).alias("total_spent"),
            mean(F.col("amt"), params.amount_decimals).alias("avg_transaction"),
            exact_deviation(F.col("amt"), params.amount_decimals).alias("std_transaction"),
            F.min("trans_date_trans_time").alias("first_transaction"),
            F.max("trans_date_trans_time").alias("last_transaction"),
            *_distances(params),
        )
        .withColumn("activity_span_days", span)
        .withColumns(
            {
                "transactions_per_day": guarded_rate(
                    F.col("total_transactions"), F.col("activity_span_days")
                ),
                "avg_geo_distance": F.col("avg_distance"),
            }
        )
    )


def user_facets(totals: DataFrame, facets: Sequence[str] = FACETS) -> DataFrame:
    """Distinct categories and merchants and the peak hour of each user, from
    ``user_dimension_totals``.

    The totals are grouped by value, so a heavy user spreads over many tasks there and comes
    in here as one row per distinct value.
    """
    dimension, value = F.col("dimension"), F.col("value")
    hour = F.when(dimension == "hour", value.cast("int"))
    # The earliest of the equally busy hours wins.
    order = F.when(dimension == "hour", F.struct(F.col("n"), -hour))
    makers = {
        "category": F.count_if((dimension == "category") & value.isNotNull()).alias("unique_categories"),
        "merchant": F.count_if((dimension == "merchant") & value.isNotNull()).alias("unique_merchants"),
        "hour": F.max_by(hour, order).alias("peak_hour"),
    }
    return (
        totals.where(dimension.isin(*facets)).groupBy("cc_num").agg(*(makers[f] for f in facets))
    )


def user_profiles(
    df: DataFrame,
    params: Params = Params(),
    facets: Sequence[str] = FACETS,
    totals: DataFrame | None = None,
    summed: DataFrame | None = None,
) -> DataFrame:
    """The whole profile; fewer ``facets`` leave their columns out and save the work.

    ``totals`` are the ``user_dimension_totals`` and ``summed`` the ``user_totals`` of ``df`` if
    they are at hand.
    """
    if totals is None:
        totals = user_dimension_totals(df, facets, params)
    if summed is None:
        summed = user_totals(df, params)
    joined = attach(summed, user_facets(totals, facets), ["cc_num"])
    return fill_deviations(joined).select(*(c for c in PROFILE_COLUMNS if c in joined.columns))


def fill_deviations(profiles: DataFrame) -> DataFrame:
    """A single transaction has no deviation; report 0 for every ``std`` column."""
    return profiles.na.fill(0, subset=[c for c in profiles.columns if "std" in c])


def user_geo_stats(df: DataFrame, params: Params = Params()) -> DataFrame:
    return df.groupBy("cc_num").agg(*_distances(params))


def user_hour_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("cc_num", "hour").agg(F.count(F.lit(1)).alias("hour_count"))


def peak_hours(df: DataFrame) -> DataFrame:
    """Busiest hour per user as an aggregate, without sorting."""
    order = F.struct(F.col("hour_count"), -F.col("hour"))
    return user_hour_counts(df).groupBy("cc_num").agg(F.max_by("hour", order).alias("peak_hour"))


def peak_hours_ranked(df: DataFrame) -> DataFrame:
    """The same by rank; a user has at most 25 rows (24 hours and NULL) to sort."""
    order = Window.partitionBy("cc_num").orderBy(F.desc("hour_count"), F.asc_nulls_last("hour"))
    return (
        user_hour_counts(df)
        .withColumn("rn", F.row_number().over(order))
        .where(F.col("rn") == 1)
        .select("cc_num", F.col("hour").alias("peak_hour"))
    )
