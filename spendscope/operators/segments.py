"""Interesting against ordinary users."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendscope.functions import mean, percent
from spendscope.operators.joins import attach, rows_of, rows_without
from spendscope.operators.usertotals import user_dimension_totals
from spendscope.params import Params

DIMENSIONS = ("category", "hour", "state", "amount_bin")
# Fixed value: keeps the amount ratio defined where ordinary users spend nothing.
RATIO_EPSILON = 1e-6


def interesting_transactions(df: DataFrame, users: DataFrame) -> DataFrame:
    """The rows of ``users``; a set beyond the broadcast threshold is turned into a filter first."""
    return rows_of(df, users, "cc_num")


def normal_transactions(df: DataFrame, users: DataFrame) -> DataFrame:
    """All other rows; those without a user are among them."""
    return rows_without(df, users, "cc_num")


def segment_row_share(df: DataFrame, users: DataFrame) -> DataFrame:
    """Rows of interesting users, all rows and the percentage.

    Rows are counted per user before the join, so the join sees one row per user.
    """
    per_user = df.groupBy("cc_num").agg(F.count(F.lit(1)).alias("n"))
    return _row_share(per_user.join(users.withColumn("interesting", F.lit(True)), "cc_num", "left"))


def _row_share(marked: DataFrame) -> DataFrame:
    inside = F.coalesce(F.sum(F.when(F.col("interesting"), F.col("n"))), F.lit(0))
    counts = marked.agg(
        inside.cast("bigint").alias("interesting_rows"),
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("all_rows"),
    )
    return counts.withColumn("percent", percent(F.col("interesting_rows"), F.col("all_rows")))


def row_share_of(totals: DataFrame, users: DataFrame) -> DataFrame:
    """``segment_row_share`` from ``user_dimension_totals``: any one dimension counts each row once."""
    one = totals.where(F.col("dimension") == "hour").select("cc_num", "n")
    marked = one.join(users.withColumn("interesting", F.lit(True)), "cc_num", "left")
    return _row_share(marked)


def compare_segments(
    df: DataFrame, users: DataFrame, dimensions: Sequence[str], params: Params = Params()
) -> DataFrame:
    """Both segments side by side for each value of each dimension, in one pass."""
    return compare_totals(user_dimension_totals(df, dimensions, params), users)


def compare_totals(totals: DataFrame, users: DataFrame) -> DataFrame:
    """The comparison from ``user_dimension_totals``: no raw row is shuffled for the join.

    Values missing in a segment count 0 there.
    """
    marked = totals.join(users.withColumn("interesting", F.lit(True)), "cc_num", "left")
    interesting = F.coalesce(F.col("interesting"), F.lit(False))

    def side(inside: Column, suffix: str) -> list[Column]:
        def only(c: str) -> Column:
            return F.sum(F.when(inside, F.col(c)))

        average = F.try_divide(only("amount").cast("double"), only("amounts"))
        return [
            F.coalesce(only("transactions"), F.lit(0)).cast("bigint").alias(f"count_{suffix}"),
            F.coalesce(average, F.lit(0.0)).alias(f"avg_{suffix}"),
            F.count_if(inside & F.col("cc_num").isNotNull()).alias(f"users_{suffix}"),
        ]

    sides = marked.groupBy("dimension", "value").agg(
        *side(~interesting, "normal"), *side(interesting, "interesting")
    )
    return _relate(sides, ["dimension"]).orderBy("dimension", F.desc("share_diff"), F.asc("value"))


def compare_by(df: DataFrame, users: DataFrame, dimension: str, params: Params = Params()) -> DataFrame:
    """The comparison along one dimension, most over-represented value first."""
    compared = compare_segments(df, users, [dimension], params).drop("dimension")
    value = F.col("value").cast(df.schema[dimension].dataType)
    return (
        compared.withColumn("value", value)
        .withColumnRenamed("value", dimension)
        .orderBy(F.desc("share_diff"), F.asc(dimension))
    )


def compare_split(
    normal: DataFrame, interesting: DataFrame, dimension: str, params: Params = Params()
) -> DataFrame:
    """The same from two tables of rows: one aggregate each and a full outer join."""

    def side(rows: DataFrame, suffix: str) -> DataFrame:
        return rows.groupBy(dimension).agg(
            F.count("trans_num").alias(f"count_{suffix}"),
            mean(F.col("amt"), params.amount_decimals).alias(f"avg_{suffix}"),
            F.count_distinct("cc_num").alias(f"users_{suffix}"),
        )

    joined = side(normal, "normal").join(side(interesting, "interesting"), dimension, "full")
    filled = joined.na.fill(0, subset=[c for c in joined.columns if c != dimension])
    return _relate(filled, []).orderBy(F.desc("share_diff"), F.asc(dimension))


def _relate(sides: DataFrame, keys: list[str]) -> DataFrame:
    """Shares of the totals per ``keys``, and what is derived from them.

    The totals are combined on the map side and joined back, so a dimension may have any
    number of values.
    """
    counts = [f"count_{s}" for s in ("normal", "interesting")]
    totals = sides.groupBy(*keys).agg(*(F.sum(c).alias(f"all_{c}") for c in counts))
    # Without keys the totals are one row.
    joined = attach(sides, totals, keys) if keys else sides.join(F.broadcast(totals), F.lit(True))
    shares = {f"share_{c[6:]}": F.try_divide(F.col(c), F.col(f"all_{c}")) for c in counts}
    return (
        joined.withColumns(shares)
        .drop(*(f"all_{c}" for c in counts))
        .withColumns(
            {
                "share_diff": F.col("share_interesting") - F.col("share_normal"),
                "amount_ratio": F.col("avg_interesting") / (F.col("avg_normal") + F.lit(RATIO_EPSILON)),
            }
        )
    )


def over_represented(comparison: DataFrame, dimension: str = "category", n: int = 10) -> DataFrame:
    """The ``n`` values where interesting users are most active relative to the others."""
    return (
        comparison.orderBy(F.desc("share_diff"), F.asc(dimension))
        .limit(n)
        .select(dimension, "share_normal", "share_interesting", "share_diff", "amount_ratio")
    )


def split(df: DataFrame, users: DataFrame) -> tuple[DataFrame, DataFrame]:
    return interesting_transactions(df, users), normal_transactions(df, users)
