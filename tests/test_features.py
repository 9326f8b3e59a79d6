import math

import pytest
from helpers import at, by_key, frame
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from spendscope.operators.features import with_features
from spendscope.operators.stats import (
    basic_stats,
    busiest_hour,
    category_stats,
    category_stats_extended,
    column_profile,
    hourly_stats,
    missing_values,
    preview,
    state_stats,
    table_shape,
    top_categories,
    type_counts,
)
from spendscope.params import Params

EDGES = [
    (-5.0, "tiny"), (0.0, "tiny"), (10.0, "tiny"), (10.01, "small"), (50.0, "small"), (100.0, "medium"),
    (500.0, "large"), (500.01, "huge"), (None, "huge"), (math.nan, "huge"),
]


def test_amount_bins(spark):
    df = with_features(frame(spark, [{"cc_num": i, "amt": a} for i, (a, _) in enumerate(EDGES)]))
    got = {r["cc_num"]: r["amount_bin"] for r in df.collect()}
    assert got == {i: label for i, (_, label) in enumerate(EDGES)}


def test_amount_bins_with_null_bin(spark):
    rows = [{"cc_num": i, "amt": a} for i, (a, _) in enumerate(EDGES)]
    got = {r["cc_num"]: r["amount_bin"] for r in with_features(frame(spark, rows), Params(null_bin=True)).collect()}
    for i, (amount, label) in enumerate(EDGES):
        missing = amount is None or math.isnan(amount) or amount <= 0
        assert got[i] == (None if missing else label)


def test_calendar_features(spark):
    days = {0: (2, 0), 5: (7, 1), 6: (1, 1)}
    df = with_features(
        frame(spark, [{"cc_num": d, "trans_date_trans_time": at(d * 86400 + 3600 * 13)} for d in days])
    )
    for day, row in by_key(df, "cc_num").items():
        assert (row["day_of_week"], row["is_weekend"]) == days[day]
        assert (row["hour"], row["month"]) == (13, 1)


def test_distance(spark):
    row = {"cc_num": 1, "lat": 40.0, "long": -70.0, "merch_lat": 43.0, "merch_long": -66.0}
    assert with_features(frame(spark, [row])).first()["geo_distance_km"] == 555.0
    without = with_features(frame(spark, [row], drop=("merch_lat",)))
    assert without.first()["geo_distance_km"] is None


def test_text_times(spark):
    df = frame(spark, [{"cc_num": 1, "trans_date_trans_time": at(7200)}])
    text = df.withColumn("trans_date_trans_time", F.lit("2019-01-01 02:00:18"))
    row = with_features(text).first()
    assert row["hour"] == 2 and row["trans_date_trans_time"].second == 18
    bad = df.withColumn("trans_date_trans_time", F.lit("soon"))
    assert with_features(bad, lenient=True).first()["hour"] is None
    with pytest.raises(PySparkException):
        with_features(bad).collect()


def test_statistics_on_small_rows(spark):
    rows = [
        {"cc_num": 1, "category": "a", "amt": 1.0, "trans_date_trans_time": at(0), "state": "X"},
        {"cc_num": 1, "category": "a", "amt": 2.0, "trans_date_trans_time": at(1), "state": "X"},
        {"cc_num": 2, "category": "a", "amt": 6.0, "trans_date_trans_time": at(3600), "state": "Y"},
        {"cc_num": None, "category": None, "amt": None, "trans_num": None, "trans_date_trans_time": at(3601)},
    ]
    df = with_features(frame(spark, rows))
    stats = by_key(category_stats(df), "category")
    assert tuple(stats["a"]) == ("a", 3, 2, 3.0)
    # A NULL key is a group; ids, users and amounts that are NULL do not count.
    assert tuple(stats[None]) == (None, 0, 0, None)
    wide = by_key(category_stats_extended(df), "category")
    assert wide["a"]["median_amount"] == 2.0 and wide["a"]["std_amount"] == 2.6458
    assert wide[None]["median_amount"] is None
    assert tuple(by_key(hourly_stats(df), "hour")[1]) == (1, 1, 6.0, 1)
    assert tuple(by_key(state_stats(df), "state")["X"]) == ("X", 2, 1.5)
    assert state_stats(df.drop("state")) is None
    assert [s is None for s in basic_stats(df.drop("state"))] == [False, False, True]
    assert tuple(busiest_hour(hourly_stats(df)).first()) == (0, 2)
    assert tuple(table_shape(df.select("cc_num", "amt")).first()) == (4, 2)
    assert preview(df, 2).count() == 2
    exact = by_key(category_stats(df, Params(amount_decimals=2)), "category")
    assert exact["a"]["avg_amount"] == 3.0 and exact[None]["avg_amount"] is None


def test_empty_input(spark):
    df = with_features(frame(spark, []))
    assert category_stats(df).count() == 0
    assert category_stats_extended(df).count() == 0
    assert top_categories(category_stats(df), 1).count() == 0
    assert busiest_hour(hourly_stats(df)).count() == 0


def test_column_profile(spark):
    df = frame(spark, [{"cc_num": 1, "amt": math.nan}, {"cc_num": None, "amt": 1.0}]).select("cc_num", "amt", "job")
    profile = column_profile(df)
    assert {tuple(r) for r in missing_values(profile).collect()} == {("cc_num", 1), ("amt", 1), ("job", 2)}
    assert {tuple(r) for r in type_counts(profile).collect()} == {("bigint", 1), ("double", 1), ("string", 1)}
    assert {r["row_count"] for r in profile.collect()} == {2}
