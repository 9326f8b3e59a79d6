"""Transactions per user and value of a dimension, the table that most results start from.

One pass over the rows yields it for any number of dimensions. It is far smaller than the
rows, a heavy user weighs one row per distinct value, and distinct users become row counts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendscope.functions import exact_amount
from spendscope.params import Params


def user_dimension_totals(
    df: DataFrame, dimensions: Sequence[str], params: Params = Params()
) -> DataFrame:
    """Columns ``cc_num, dimension, value`` (as text), ``n`` rows, ``transactions`` with an id,
    ``amount`` (the sum) and ``amounts`` (how many were summed)."""
    carried = ["cc_num", "trans_num", "amt"]
    # The amount is converted once per row, before the row is repeated per dimension.
    amount = exact_amount(F.col("amt"), params.amount_decimals).alias("amt")
    return (
        df.select("cc_num", "trans_num", amount, *(F.col(d).cast("string").alias(d) for d in dimensions))
        .unpivot(carried, list(dimensions), "dimension", "value")
        .groupBy("cc_num", "dimension", "value")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count("trans_num").alias("transactions"),
            F.sum("amt").alias("amount"),
            F.count("amt").alias("amounts"),
        )
    )


def dimension_stats(totals: DataFrame, dimension: str, count_name: str) -> DataFrame:
    """Count, average amount and users per value, from the totals instead of the rows."""
    return (
        totals.where(F.col("dimension") == dimension)
        .groupBy("value")
        .agg(
            F.sum("transactions").alias(count_name),
            F.try_divide(F.sum("amount").cast("double"), F.sum("amounts")).alias("avg_amount"),
            F.count("cc_num").alias("unique_users"),
        )
        .withColumnRenamed("value", dimension)
    )
