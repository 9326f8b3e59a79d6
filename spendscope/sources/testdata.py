"""The test tables seen as card transactions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def transactions(spark: SparkSession, sf_dir: str, with_state: bool = False) -> DataFrame:
    """``events`` as transactions; the state needs two joins and is added only on request."""
    user = F.col("user_id")
    k = F.get_json_object("props", "$.k").cast("bigint")
    events = table(spark, sf_dir, "events").select(
        F.col("event_id").alias("trans_num"),
        user.alias("cc_num"),
        F.col("ts").alias("trans_date_trans_time"),
        F.concat(F.lit("cat_"), (k % 25).cast("string")).alias("category"),
        F.concat(F.lit("m_"), k.cast("string")).alias("merchant"),
        F.col("value").alias("amt"),
        (F.lit(30) + (user % 20) * F.lit(0.5)).alias("lat"),
        (F.lit(-100) + (user % 30) * F.lit(0.5)).alias("long"),
        (((F.col("event_id") * 37 + k * 11) % 201 - 100) / F.lit(100.0)).alias("lat_shift"),
        (((F.col("event_id") * 53 + k * 7) % 201 - 100) / F.lit(100.0)).alias("long_shift"),
    )
    tx = events.withColumns(
        {"merch_lat": F.col("lat") + F.col("lat_shift"), "merch_long": F.col("long") + F.col("long_shift")}
    ).drop("lat_shift", "long_shift")
    if not with_state:
        return tx
    # One join after the other: the planner knows the size of each table, not of their join.
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("cc_num"), "c_nationkey")
    nations = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("state")
    )
    return tx.join(customers, "cc_num", "left").join(nations, "c_nationkey", "left").drop("c_nationkey")
