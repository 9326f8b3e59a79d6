"""Transactions landed once as Parquet, bucketed by user.

CSV is parsed in a single pass, without a shuffle, into plain Parquet. From there the rows go into
buckets by user, so later aggregates per user find all of a user's rows in one task and need no
exchange. A user with more rows than an average bucket would make one task long: there can be no
more such users than buckets, and their rows are kept apart, in the order of user and time, in
files of even size. Aggregates per user run on both tables and are put together.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendscope.operators.joins import attach
from spendscope.session import scratch_path, stored
from spendscope.sources.sinks import write_by_user

USER, TIME = "cc_num", "trans_date_trans_time"


@dataclass(frozen=True)
class Landed:
    """Rows by user: ``light`` is bucketed, ``heavy`` holds the few users that would fill a bucket."""

    light: DataFrame
    heavy: DataFrame
    name: str

    @property
    def rows(self) -> DataFrame:
        return self.light.unionByName(self.heavy)

    def per_user(self, aggregate: Callable[[DataFrame], DataFrame]) -> DataFrame:
        """An aggregate by user over all rows; no user is in both tables."""
        return aggregate(self.light).unionByName(aggregate(self.heavy))

    def drop(self) -> None:
        """Forget the bucketed table; its files go with the scratch folder."""
        self.light.sparkSession.sql(f"DROP TABLE IF EXISTS {self.name}")


def land_once(df: DataFrame) -> DataFrame:
    """The rows as a scratch table, so that a slow source such as CSV is read in one pass."""
    return stored(df, "landed-once")


def land_by_user(df: DataFrame, buckets: int | None = None) -> Landed:
    """Bucket ``df`` by user; by default there are as many buckets as shuffle partitions.

    ``df`` is read twice, once for the users' counts, so a slow source should be landed first. The tables
    lie in the scratch folder and belong to this session. Rows without a user count as one user's.
    """
    spark = df.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    counts = stored(df.groupBy(USER).agg(F.count(F.lit(1)).alias("n")), "user-counts")
    average = counts.agg(F.coalesce(F.sum("n"), F.lit(0)) / buckets).first()[0]
    # Fewer than there are buckets, so they can go to every task.
    heavy = counts.where(F.col("n") > average).select(USER, F.lit(True).alias("__heavy"))
    marked = attach(df, F.broadcast(heavy), [USER])

    name, light_path, heavy_path = f"landed_{uuid.uuid4().hex}", scratch_path(spark, "landed-light"), scratch_path(spark, "landed-heavy")
    light = marked.where("__heavy is null").drop("__heavy").repartition(buckets, USER)
    light.write.bucketBy(buckets, USER).sortBy(USER, TIME).option("path", light_path).saveAsTable(name)
    write_by_user(marked.where("__heavy").drop("__heavy"), heavy_path)
    return Landed(spark.table(name), spark.read.schema(df.schema).parquet(heavy_path), name)

