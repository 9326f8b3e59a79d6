import random
import statistics
from dataclasses import replace

import pytest
from helpers import at, by_key, frame, rows
from pyspark.sql import functions as F

from spendscope.operators.criteria import (
    CRITERIA,
    amount_threshold,
    flag_users,
    high_amount,
    interesting_summary,
    interesting_users,
    interesting_users_union,
    user_flags,
)
from spendscope.operators.features import with_features
from spendscope.operators.profiles import (
    PROFILE_COLUMNS,
    peak_hours,
    peak_hours_ranked,
    user_profiles,
    user_totals,
)
from spendscope.operators.segments import (
    compare_by,
    compare_segments,
    compare_split,
    over_represented,
    segment_row_share,
    split,
)
from spendscope.params import Params


def sample(seed=1, n=1500, users=40):
    """A third of the rows belong to user 0; some rows have no user, category, amount or time."""
    r = random.Random(seed)

    def maybe(value, p=0.02):
        return None if r.random() < p else value

    return [
        {
            "cc_num": 0 if i % 3 == 0 else maybe(r.randrange(1, users)),
            "category": maybe(f"c{r.randrange(12)}"),
            "merchant": maybe(f"m{r.randrange(60)}"),
            "amt": maybe(round(r.expovariate(1 / 60), 2)),
            "trans_date_trans_time": maybe(at(r.randrange(20 * 86400))),
            "lat": 40.0, "long": -70.0,
            "merch_lat": 40.0 + r.uniform(-1.2, 1.2), "merch_long": -70.0 + r.uniform(-1.2, 1.2),
            "state": r.choice(["X", "Y", "Z"]),
        }
        for i in range(n)
    ]


TUNED = Params(daily_rate=1.6, distance_km=175, categories=12, gap_seconds=1800, short_gaps=2, amount_decimals=2)


@pytest.fixture(scope="module")
def tx(spark):
    return with_features(frame(spark, sample())).cache()


@pytest.fixture(scope="module")
def flags(tx):
    return flag_users(tx, TUNED).cache()


def test_profiles_against_plain_python(spark, tx):
    got = by_key(user_profiles(tx, TUNED), "cc_num")
    groups = {}
    for row in tx.collect():
        groups.setdefault(row["cc_num"], []).append(row)
    assert set(got) == set(groups) and None in got
    for user, members in groups.items():
        p = got[user]
        amounts = [m["amt"] for m in members if m["amt"] is not None]
        times = [m["trans_date_trans_time"] for m in members if m["trans_date_trans_time"] is not None]
        distances = [m["geo_distance_km"] for m in members]
        assert p["total_transactions"] == len(members)
        assert p["total_spent"] == pytest.approx(sum(amounts))
        assert p["avg_transaction"] == pytest.approx(statistics.fmean(amounts))
        assert p["std_transaction"] == pytest.approx(statistics.stdev(amounts))
        assert p["unique_categories"] == len({m["category"] for m in members} - {None})
        assert p["unique_merchants"] == len({m["merchant"] for m in members} - {None})
        assert (p["first_transaction"], p["last_transaction"]) == (min(times), max(times))
        assert p["activity_span_days"] == (max(times).date() - min(times).date()).days
        assert p["transactions_per_day"] == len(members) / max(p["activity_span_days"], 1)
        hours = [m["hour"] for m in members]
        best = max(set(hours), key=lambda h: (hours.count(h), -1 if h is None else 0, -(h or 0)))
        assert p["peak_hour"] == best
        assert p["max_distance"] == max(distances)
        assert p["avg_distance"] == p["avg_geo_distance"] == pytest.approx(statistics.fmean(distances))
        assert p["std_distance"] == pytest.approx(statistics.stdev(distances))


def test_profile_columns(tx):
    assert tuple(user_profiles(tx).columns) == PROFILE_COLUMNS


def test_single_transaction(spark):
    row = {"cc_num": 1, "amt": 5.0, "trans_date_trans_time": at(0), "category": "a", "merchant": "m"}
    for span in ("days", "exact"):
        p = user_profiles(with_features(frame(spark, [row])), Params(span=span)).first()
        assert (p["std_transaction"], p["std_distance"]) == (0.0, 0.0)
        assert (p["activity_span_days"], p["transactions_per_day"]) == (0, 1.0)


def test_span_over_midnight(spark):
    times = (at(86400 - 60), at(86400 + 60))
    df = with_features(frame(spark, [{"cc_num": 1, "trans_date_trans_time": t} for t in times]))
    assert user_totals(df).first()["activity_span_days"] == 1
    assert user_totals(df, Params(span="exact")).first()["activity_span_days"] == 120 / 86400


def test_peak_hour_tie_and_both_forms(spark, tx):
    times = [9, 9, 17, 17]
    df = with_features(frame(spark, [{"cc_num": 1, "trans_date_trans_time": at(h * 3600)} for h in times]))
    assert rows(peak_hours(df)) == rows(peak_hours_ranked(df)) == [(1, 9)]
    assert rows(peak_hours(tx)) == rows(peak_hours_ranked(tx))


def test_missing_positions(spark):
    df = with_features(frame(spark, [{"cc_num": 1, "trans_date_trans_time": at(0), "amt": 1.0}], drop=("lat",)))
    flags = flag_users(df).first()
    assert flags["geo_mobile"] is False
    assert user_profiles(df).first()["max_distance"] is None


def test_flags_equal_union(tx, flags):
    union = interesting_users_union(user_profiles(tx, TUNED), tx, TUNED)
    assert rows(interesting_users(flags)) == rows(union)
    for r in flags.collect():
        assert r["interesting"] == any(r[c] for c in CRITERIA)
    assert 0 < interesting_users(flags).count() < flags.count()


def test_summary(flags):
    found = by_key(interesting_summary(flags), "criterion")
    all_users = flags.count()
    for c in (*CRITERIA, "interesting"):
        n = flags.where(c).count()
        assert tuple(found[c]) == (c, n, all_users, n / all_users * 100)


def test_few_users_have_no_high_amount(spark):
    df = with_features(frame(spark, [{"cc_num": i, "amt": float(i)} for i in range(19)]))
    assert high_amount(user_totals(df)).count() == 0
    assert high_amount(user_totals(df), params=Params(amount_method="interpolated")).count() == 1


def test_amount_population(spark):
    rows_ = [{"cc_num": 1, "amt": 10.0}] * 90 + [{"cc_num": 2, "amt": 100.0}] * 10
    df = with_features(frame(spark, rows_))
    params = Params(amount_population="transactions", amount_quantile=0.5)
    assert amount_threshold(user_totals(df), df, params).first()[0] == 10.0
    assert rows(high_amount(user_totals(df), df, params)) == [(2,)]
    with pytest.raises(ValueError):
        amount_threshold(user_totals(df), None, params)


def test_no_rows(spark):
    df = with_features(frame(spark, []))
    flags = flag_users(df)
    assert flags.count() == 0 and amount_threshold(user_totals(df)).first()[0] is None
    assert {tuple(r)[1:] for r in interesting_summary(flags).collect()} == {(0, 0, 0.0)}
    assert compare_by(df, interesting_users(flags), "category").count() == 0
    assert tuple(segment_row_share(df, interesting_users(flags)).first()) == (0, 0, 0.0)


def test_window_option(spark, tx):
    params = replace(TUNED, burst="window", window_transactions=2)
    narrow = user_flags(user_profiles(tx, params), tx, params)
    assert narrow.where("burst").count() > 0


def test_segments_partition_the_rows(spark, tx, flags):
    users = interesting_users(flags)
    interesting, normal = split(tx, users)
    assert interesting.count() + normal.count() == tx.count()
    no_user = tx.where(F.col("cc_num").isNull()).count()
    assert normal.where(F.col("cc_num").isNull()).count() == no_user > 0
    assert tuple(segment_row_share(tx, users).first())[:2] == (interesting.count(), tx.count())


@pytest.mark.parametrize("dimension", ["hour", "state", "amount_bin"])
def test_comparison_forms_agree(tx, flags, dimension):
    users = interesting_users(flags)
    known = tx.where(F.col(dimension).isNotNull())
    one = compare_by(known, users, dimension, TUNED)
    interesting, normal = split(known, users)
    other = compare_split(normal, interesting, dimension, TUNED)
    assert sorted(one.columns) == sorted(other.columns)
    assert rows(one.select(sorted(one.columns))) == rows(other.select(sorted(one.columns)))


def test_comparison_properties(tx, flags):
    users = interesting_users(flags)
    dimensions = ["category", "hour", "state", "amount_bin"]
    all_rows = compare_segments(tx, users, dimensions, TUNED).collect()
    for d in dimensions:
        part = [r for r in all_rows if r["dimension"] == d]
        assert sum(r["share_normal"] for r in part) == pytest.approx(1)
        assert sum(r["share_interesting"] for r in part) == pytest.approx(1)
        assert sum(r["count_normal"] + r["count_interesting"] for r in part) == tx.count()
        assert [r["share_diff"] for r in part] == sorted((r["share_diff"] for r in part), reverse=True)


def test_value_in_one_segment_only(spark):
    data = [
        {"cc_num": 1, "category": "both", "amt": 2.0}, {"cc_num": 2, "category": "both", "amt": 4.0},
        {"cc_num": 1, "category": "left", "amt": 1.0}, {"cc_num": 2, "category": "right", "amt": 5.0},
    ]
    df = with_features(frame(spark, data))
    users = spark.createDataFrame([(2,)], "cc_num bigint")
    got = by_key(compare_by(df, users, "category"), "category")
    assert (got["left"]["count_interesting"], got["left"]["avg_interesting"], got["left"]["users_interesting"]) == (0, 0.0, 0)
    assert got["right"]["amount_ratio"] == 5.0 / 1e-6
    top = over_represented(compare_by(df, users, "category"), n=1).collect()
    assert [r["category"] for r in top] == ["right"]


def test_results_do_not_depend_on_partitioning(tx, flags):
    shuffled = tx.repartition(13, F.rand(3))
    assert rows(flag_users(shuffled, TUNED)) == rows(flags)
    single = tx.coalesce(1)
    assert rows(flag_users(single, TUNED)) == rows(flags)
