"""The five behavioural criteria and the set of users that meet any of them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendscope.functions import percent
from spendscope.operators.gaps import burst_users, window_burst_users
from spendscope.operators.joins import attach
from spendscope.operators.profiles import user_profiles
from spendscope.operators.quantiles import exact_quantile
from spendscope.operators.sketches import sketched_quantile, value_sketches
from spendscope.params import Params
from spendscope.session import stored

CRITERIA = ("high_frequency", "high_amount", "geo_mobile", "diverse", "burst")


def high_frequency(profiles: DataFrame, params: Params = Params()) -> DataFrame:
    return profiles.where(F.col("transactions_per_day") > params.daily_rate).select("cc_num")


def amount_threshold(
    profiles: DataFrame, df: DataFrame | None = None, params: Params = Params()
) -> DataFrame:
    """One row: the quantile of the users' average amounts, or of all amounts in ``df``.

    It stays in the plan, where the criteria read it as a scalar subquery; no values give NULL.
    """
    rows, value = profiles, "avg_transaction"
    if params.amount_population == "transactions":
        if df is None:
            raise ValueError("the transactions are needed for amount_population='transactions'")
        rows, value = df, "amt"
    if params.amount_method == "sketch":
        return sketched_quantile(value_sketches(rows, value), params.amount_quantile)
    return exact_quantile(rows, value, params.amount_quantile, method=params.amount_method)


def high_amount(profiles: DataFrame, df: DataFrame | None = None, params: Params = Params()) -> DataFrame:
    threshold = amount_threshold(profiles, df, params).scalar()
    return profiles.where(F.col("avg_transaction") > threshold).select("cc_num")


def geo_mobile(profiles: DataFrame, params: Params = Params()) -> DataFrame:
    return profiles.where(F.col("max_distance") > params.distance_km).select("cc_num")


def diverse(profiles: DataFrame, params: Params = Params()) -> DataFrame:
    return profiles.where(F.col("unique_categories") >= params.categories).select("cc_num")


def bursts(df: DataFrame, params: Params = Params()) -> DataFrame:
    return burst_users(df, params) if params.burst == "gaps" else window_burst_users(df, params)


def user_flags(profiles: DataFrame, df: DataFrame, params: Params = Params()) -> DataFrame:
    """One row per user with a flag per criterion and ``interesting``, their OR."""
    threshold = amount_threshold(profiles, df, params).scalar()
    marked = attach(profiles, bursts(df, params).withColumn("burst", F.lit(True)), ["cc_num"])
    conditions = {
        "high_frequency": F.col("transactions_per_day") > params.daily_rate,
        "high_amount": F.col("avg_transaction") > threshold,
        "geo_mobile": F.col("max_distance") > params.distance_km,
        "diverse": F.col("unique_categories") >= params.categories,
        "burst": F.col("burst"),
    }
    flags = marked.select(
        "cc_num", *(F.coalesce(conditions[c], F.lit(False)).alias(c) for c in CRITERIA)
    )
    return flags.withColumn("interesting", reduce(lambda a, b: a | b, (F.col(c) for c in CRITERIA)))


def flag_users(df: DataFrame, params: Params = Params()) -> DataFrame:
    """``user_flags`` straight from the transactions, computing only what the criteria read.

    Sums of plain doubles may differ from one evaluation to the next. Without
    ``amount_decimals`` the profiles are therefore stored first, which runs a job, so that the
    averages and the threshold taken from them are the same ones.
    """
    profiles = user_profiles(df, params, facets=("category",))
    if params.amount_decimals is None:
        profiles = stored(profiles, "profiles")
    return user_flags(profiles, df, params)


def interesting_users(flags: DataFrame) -> DataFrame:
    return flags.where("interesting").select("cc_num")


def interesting_users_union(profiles: DataFrame, df: DataFrame, params: Params = Params()) -> DataFrame:
    """The same set as a union of the five criteria without duplicates."""
    sets = [
        high_frequency(profiles, params),
        high_amount(profiles, df, params),
        geo_mobile(profiles, params),
        diverse(profiles, params),
        bursts(df, params),
    ]
    return reduce(DataFrame.unionByName, sets).distinct()


def interesting_summary(flags: DataFrame) -> DataFrame:
    """Users per criterion, in the union and in all, with their percentage: one aggregate."""
    names = [*CRITERIA, "interesting"]
    counts = flags.agg(
        *(F.count_if(F.col(c)).alias(c) for c in names), F.count(F.lit(1)).alias("all_users")
    )
    return counts.unpivot("all_users", names, "criterion", "users").select(
        "criterion", "users", "all_users", percent(F.col("users"), F.col("all_users")).alias("percent")
    )
