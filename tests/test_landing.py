"""Sources parsed once, rows landed by user, filters before large joins, result sets published at once."""

import os
import random
import shutil

import pytest
from conftest import SF_SMALL
from helpers import at, frame, rows
from pyspark.sql import functions as F

from spendscope.operators import joins, profiles, segments
from spendscope.operators.features import with_features
from spendscope.plans import analyse, load
from spendscope.plans.queries import TUNED
from spendscope.session import stored
from spendscope.sources import sinks
from spendscope.sources.landing import land_by_user
from spendscope.sources.sinks import write_csv, write_set
from spendscope.sources.testdata import transactions


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def hot(spark, n=4000):
    """A third of the rows are one user's, and some have no user."""
    rng = random.Random(1)
    return frame(spark, [
        {"cc_num": 7 if i % 3 == 0 else None if i % 50 == 1 else rng.randrange(300), "trans_date_trans_time": at(i * 60),
         "category": f"c{i % 4}", "merchant": f"m{i % 9}", "amt": (i % 977) / 100, "lat": 40.0, "long": 3.0, "merch_lat": 40 + i % 5 / 10, "merch_long": 3.1}
        for i in range(n)
    ])


def test_a_csv_source_is_parsed_once(spark, tmp_path):
    path = str(tmp_path / "rows.csv")
    write_csv(transactions(spark, SF_SMALL, with_state=True), path)
    expected = rows(load(spark, path, once=False))
    loaded = load(spark, path)
    shutil.rmtree(path)
    assert rows(loaded) == expected
    with analyse(loaded, TUNED) as done:
        assert done.comparison.count() > 0 and done.category_stats.count() > 0
        assert "FileScan csv" not in plan(done.interesting)


def test_rows_by_user(spark):
    df = hot(spark)
    landed = land_by_user(df, 8)
    assert rows(landed.rows) == rows(df)
    heavy = {r["cc_num"] for r in landed.heavy.select("cc_num").distinct().collect()}
    assert heavy == {7} and landed.light.where("cc_num = 7").isEmpty()
    # No bucket is much larger than the others.
    sizes = [r["n"] for r in landed.light.groupBy(F.col("_metadata.file_name")).agg(F.count(F.lit(1)).alias("n")).collect()]
    assert max(sizes) <= 2 * 4000 / 8
    totals = profiles.user_totals(with_features(landed.light, TUNED), TUNED)
    assert "Exchange" not in plan(totals) and "Exchange" in plan(profiles.user_totals(with_features(df, TUNED), TUNED))
    got = landed.per_user(lambda part: profiles.user_totals(with_features(part, TUNED), TUNED))
    assert rows(got) == rows(profiles.user_totals(with_features(df, TUNED), TUNED))
    landed.drop()
    assert not spark.catalog.tableExists(landed.name)


def test_analysis_of_landed_rows(spark):
    source = transactions(spark, SF_SMALL, with_state=True)
    with analyse(source, TUNED) as plain, analyse(land_by_user(source, 4), TUNED) as landed:
        for name in ("profiles", "flags", "users", "comparison", "category_stats", "row_share", "summary"):
            assert rows(getattr(landed, name)) == rows(getattr(plain, name)), name
        assert rows(landed.interesting.select(*plain.interesting.columns)) == rows(plain.interesting)
    assert land_by_user(source.limit(0), 4).rows.count() == 0


@pytest.fixture()
def tiny_broadcasts(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1000")
    yield spark
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_a_large_user_set_is_a_filter_first(tiny_broadcasts):
    spark = tiny_broadcasts
    df = spark.range(20_000).select(F.when(F.col("id") % 100 > 0, F.col("id") % 4000).alias("cc_num"), F.col("id").alias("trans_num"))
    users = stored(spark.range(0, 4000, 3).select(F.col("id").alias("cc_num")), "users")
    inside, outside = segments.split(df, users)
    expected = {r["trans_num"] for r in df.collect() if r["cc_num"] is not None and r["cc_num"] % 3 == 0}
    assert {r["trans_num"] for r in inside.collect()} == expected
    assert sorted(r["trans_num"] for r in outside.collect()) == [i for i in range(20_000) if i not in expected]
    for part in (inside, outside):
        assert "__mask" in plan(part) and "BroadcastHashJoin" in plan(part)
    assert outside.columns == inside.columns == df.columns
    # Most other rows never reach the join that shuffles.
    likely = joins._possible(df, "cc_num", joins.member_filter(users, "cc_num")).where("__possible").count()
    assert len(expected) <= likely < len(expected) + 0.15 * (20_000 - len(expected))


def test_a_full_filter_changes_nothing(tiny_broadcasts, monkeypatch):
    spark = tiny_broadcasts
    monkeypatch.setattr(joins, "MOST_BITS", 10)
    df = spark.range(5000).withColumnRenamed("id", "cc_num")
    users = stored(df.where("cc_num % 2 = 0"), "users")
    assert joins.rows_of(df, users, "cc_num").count() == joins.rows_without(df, users, "cc_num").count() == 2500


def test_a_small_or_unknown_set_is_joined_directly(spark, tiny_broadcasts):
    df = spark.range(50).withColumnRenamed("id", "cc_num")
    for users in (df.where("cc_num < 5"), df.limit(3).cache()):
        assert "__mask" not in plan(joins.rows_of(df, users, "cc_num"))


def test_a_set_of_tables_appears_at_once(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "results")
    first = {"a": spark.range(3), "b": spark.range(5)}
    write_set(first, path)
    assert sorted(os.listdir(path)) == ["a", "b"]
    real = sinks.write_parquet

    def failing(frame, place, mode="overwrite"):
        if place.endswith("/b"):
            raise RuntimeError("lost")
        real(frame, place, mode)

    monkeypatch.setattr(sinks, "write_parquet", failing)
    with pytest.raises(RuntimeError, match="lost"):
        write_set({"a": spark.range(30), "b": spark.range(50)}, path)
    assert [spark.read.parquet(f"{path}/{n}").count() for n in "ab"] == [3, 5]
    assert os.listdir(tmp_path) == ["results"]
    monkeypatch.setattr(sinks, "write_parquet", real)
    # The new set may read the old one.
    write_set({"a": spark.read.parquet(f"{path}/a").union(spark.range(1)), "b": spark.range(50)}, path)
    assert [spark.read.parquet(f"{path}/{n}").count() for n in "ab"] == [4, 50]
    assert os.listdir(tmp_path) == ["results"]


def test_other_files_are_not_replaced(spark, tmp_path):
    (tmp_path / "results").mkdir()
    (tmp_path / "results" / "notes.txt").write_text("mine")
    with pytest.raises(ValueError, match="notes.txt"):
        write_set({"a": spark.range(3)}, str(tmp_path / "results"))
    assert (tmp_path / "results" / "notes.txt").read_text() == "mine"


@pytest.mark.parametrize("decimals", [2, None])
def test_deviations_do_not_depend_on_the_order_of_addition(spark, decimals):
    from dataclasses import replace

    from spendscope.operators import stats

    params = replace(TUNED, amount_decimals=decimals)
    df = with_features(hot(spark), params)
    builds = (
        lambda d: profiles.user_totals(d, params),
        lambda d: profiles.user_geo_stats(d, params),
        lambda d: stats.category_stats_extended(d, params, digits=15),
    )
    for build in builds:
        found = [{r[0]: tuple(r) for r in build(df.orderBy(F.rand(n)).repartition(n)).collect()} for n in (1, 7, 50)]
        if decimals is None:
            assert all(set(f) == set(found[0]) for f in found)
        else:
            assert found[0] == found[1] == found[2]  # to the last bit


def test_exact_deviation_against_plain(spark):
    import math
    import statistics

    from spendscope.functions import exact_deviation, exact_mean

    rng = random.Random(5)
    groups = {
        1: [rng.gauss(80, 30) for _ in range(500)], 2: [12.34] * 40, 3: [5.0], 4: [1e6 + rng.random() for _ in range(200)],
        5: [None, 2.5, None, 3.5], 6: [None], 7: [1e300, 2e300, -1e300], 8: [-3.25, 3.25],
    }
    df = spark.createDataFrame([(k, v) for k, own in groups.items() for v in own], "k long, v double")
    got = {r["k"]: r for r in df.groupBy("k").agg(exact_deviation(F.col("v"), 11).alias("d"), exact_mean(F.col("v"), 11).alias("m")).collect()}
    for k, own in groups.items():
        own = [v for v in own if v is not None]
        if k == 7:
            assert got[k]["m"] == pytest.approx(2e300 / 3) and got[k]["d"] is not None
            continue
        assert got[k]["m"] == (pytest.approx(statistics.fmean(own), rel=1e-13) if own else None)
        assert got[k]["d"] == (pytest.approx(statistics.stdev(own), rel=1e-9, abs=0) if len(own) > 1 else None)
    assert got[2]["d"] == 0.0
    weighted = df.where("k in (1, 2)").withColumn("w", F.lit(3)).groupBy("k").agg(exact_deviation(F.col("v"), 11, F.col("w")).alias("d")).collect()
    for r in weighted:
        assert r["d"] == pytest.approx(statistics.stdev(groups[r["k"]] * 3), rel=1e-9, abs=0) and math.isfinite(r["d"])
