"""Mergeable summaries against exact results: stated errors, merging, missing values, defaults."""

import math
import random

import pytest
from helpers import at, by_key, frame, numbers
from pyspark.sql import functions as F

from spendscope.operators import criteria, sketches, stats
from spendscope.operators.features import with_features
from spendscope.params import Params


def skewed(spark, n=30_000):
    """A third of the rows are one user's; the others have few each."""
    row = F.col("id")
    return spark.range(n).select(
        F.when(row % 3 == 0, 7).otherwise(1000 + row % 9000).alias("cc_num"),
        row.cast("string").alias("trans_num"),
        F.concat(F.lit("c"), (row % 5).cast("string")).alias("category"),
        F.concat(F.lit("m"), (F.xxhash64("id") % 4000).cast("string")).alias("merchant"),
        F.exp(F.randn(3) * 4).alias("amt"),
    )


def test_distinct_users_are_within_the_stated_error(spark):
    tx = skewed(spark).cache()
    exact = by_key(tx.groupBy("category").agg(F.count_distinct("cc_num").alias("users"), F.count("trans_num").alias("n")), "category")
    for lg_k in (8, 12, 16):
        parts = [sketches.dimension_sketches(tx.where(F.col("cc_num") % 4 == i), ["category"], lg_k=lg_k) for i in range(4)]
        for table in (sketches.dimension_sketches(tx, ["category"], lg_k=lg_k), sketches.merge_dimension_sketches(*parts)):
            got = by_key(sketches.sketched_stats(table, "category", "n"), "category")
            assert set(got) == set(exact)
            for c, row in exact.items():
                assert got[c]["n"] == row["n"]
                assert abs(got[c]["unique_users"] - row["users"]) <= row["users"] * sketches.distinct_error(lg_k)
    tx.unpersist()


def test_sketches_can_be_kept_and_merged_later(spark, tmp_path):
    tx = skewed(spark, 6000)
    for day in range(2):
        sketches.user_sketches(tx.where(F.col("trans_num").cast("long") % 2 == day)).write.parquet(str(tmp_path / str(day)))
    kept = [spark.read.parquet(str(tmp_path / str(day))) for day in range(2)]
    got = by_key(sketches.sketched_facets(sketches.merge_user_sketches(*kept)), "cc_num")
    exact = by_key(tx.groupBy("cc_num").agg(F.count_distinct("category").alias("c"), F.count_distinct("merchant").alias("m")), "cc_num")
    assert set(got) == set(exact)
    for user, row in exact.items():
        assert got[user]["unique_categories"] == row["c"]  # small counts are exact
        assert abs(got[user]["unique_merchants"] - row["m"]) <= row["m"] * sketches.distinct_error()


def test_different_sizes_merge_into_the_smallest(spark):
    tx = skewed(spark, 6000)
    merged = sketches.merge_dimension_sketches(*(sketches.dimension_sketches(tx, ["category"], lg_k=k) for k in (10, 14)))
    users = tx.where("category = 'c1'").agg(F.count_distinct("cc_num")).first()[0]
    got = sketches.sketched_stats(merged, "category", "n").where("category = 'c1'").first()
    assert abs(got["unique_users"] - users) <= users * sketches.distinct_error(10)


@pytest.mark.parametrize("k", [100, 800, 4000])
def test_rank_error_on_skewed_values(spark, k):
    rng = random.Random(k)
    values = [math.exp(rng.gauss(0, 5)) for _ in range(15_000)] + [1.0] * 5000  # a quarter is one value
    df = numbers(spark, values).repartition(8)
    ordered = sorted(values)
    parts = [sketches.value_sketches(part, "v", k=k) for part in df.randomSplit([1.0, 2.0, 0.1], seed=1)]
    for table in (sketches.value_sketches(df, "v", k=k), sketches.merge_value_sketches(*parts)):
        for p in (0.0, 0.05, 0.5, 0.95, 1.0):
            q = sketches.sketched_quantile(table, p).first()[0]
            below, upto = (sum(1 for v in ordered if v < q) / len(ordered), sum(1 for v in ordered if v <= q) / len(ordered))
            # Twice the stated error: it is one that 1 of 100 sketches may break.
            assert below <= p + 2 * sketches.rank_error(k) and upto >= p - 2 * sketches.rank_error(k)


def test_missing_values(spark):
    nothing = sketches.sketched_quantile(sketches.value_sketches(numbers(spark, [None, math.nan]), "v"), 0.5)
    assert [tuple(r) for r in nothing.collect()] == [(None,)]
    assert [tuple(r) for r in sketches.sketched_quantile(sketches.value_sketches(numbers(spark, []), "v"), 0.5).collect()] == [(None,)]
    assert sketches.sketched_quantile(sketches.value_sketches(numbers(spark, [None, math.nan, 3.0]), "v"), 0.5).first()[0] == 3.0
    rows = frame(spark, [{"cc_num": None, "category": None, "amt": None}, {"cc_num": 5, "category": None, "amt": 2.0}])
    got = sketches.sketched_stats(sketches.dimension_sketches(rows, ["category"]), "category", "n").collect()
    assert [tuple(r) for r in got] == [(None, 2, 2.0, 1)]
    assert sketches.merge_dimension_sketches(sketches.dimension_sketches(rows.limit(0), ["category"])).count() == 0


def test_exact_is_the_default(spark):
    assert Params().distinct == "exact" and Params().amount_method == "rank"
    with pytest.raises(ValueError):
        Params(distinct="some")
    tx = with_features(frame(spark, [
        {"cc_num": u, "category": "a", "amt": float(u), "trans_date_trans_time": at(u)} for u in range(200)
    ]))
    for build in (stats.category_stats, stats.category_stats_extended, stats.hourly_stats):
        exact, some = (build(tx, Params(distinct=d)).first() for d in ("exact", "sketch"))
        assert exact["unique_users"] == 200 and abs(some["unique_users"] - 200) <= 200 * sketches.distinct_error()
        assert build(tx, Params(distinct="sketch")).dtypes == build(tx).dtypes
    users = tx.select("cc_num", F.col("amt").alias("avg_transaction"))
    q = criteria.amount_threshold(users, params=Params(amount_method="sketch")).first()[0]
    assert abs(q - 190) <= 200 * 2 * sketches.rank_error() + 1
    assert criteria.high_amount(users, params=Params(amount_method="sketch")).count() in range(5, 15)
