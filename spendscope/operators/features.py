"""Row features: one projection over the transactions, no shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendscope.functions import amount_bin, day_of_week, is_weekend, planar_km
from spendscope.params import Params

GEO_COLUMNS = ("lat", "long", "merch_lat", "merch_long")


def parse_time(df: DataFrame, lenient: bool = False) -> DataFrame:
    """Turn a text event time into a timestamp; other types stay as they are.

    Bad text raises, or becomes NULL with ``lenient``.
    """
    if not isinstance(df.schema["trans_date_trans_time"].dataType, T.StringType):
        return df
    text = F.col("trans_date_trans_time")
    parsed = text.try_cast("timestamp_ntz") if lenient else text.cast("timestamp_ntz")
    return df.withColumn("trans_date_trans_time", parsed)


def with_features(df: DataFrame, params: Params = Params(), lenient: bool = False) -> DataFrame:
    """Every row, with hour, day, weekend, month, amount bin and distance added.

    Unused features cost nothing: the optimizer drops those that no query reads. Without
    the four position columns the distance is NULL.
    """
    df = parse_time(df, lenient)
    ts = F.col("trans_date_trans_time")
    if all(c in df.columns for c in GEO_COLUMNS):
        distance = planar_km(*(F.col(c) for c in GEO_COLUMNS))
    else:
        distance = F.lit(None).cast("double")
    return df.withColumns(
        {
            "hour": F.hour(ts),
            "day_of_week": day_of_week(ts),
            "is_weekend": is_weekend(ts),
            "month": F.month(ts),
            "amount_bin": amount_bin(F.col("amt"), params.null_bin),
            "geo_distance_km": distance,
        }
    )
