import random
from collections import Counter
from dataclasses import replace
from datetime import datetime

import pytest
from helpers import at, frame, rows
from pyspark.sql import functions as F

from spendscope.operators.gaps import (
    burst_users,
    carried_times,
    short_gap_counts,
    user_time_ranges,
    window_burst_users,
    with_gaps,
)
from spendscope.params import Params


def random_rows(seed, hot=400):
    """Some users with close times, repeated instants and missing values; one user is hot."""
    r = random.Random(seed)
    out = []
    for i in range(900):
        user = 0 if i < hot else r.choice([1, 2, 3, None])
        second = r.choice([r.randrange(3 * 86400), r.randrange(200), 3600 * r.randrange(5)])
        fraction = r.choice([0.0, 0.0, r.randrange(10**6) / 1e6])
        time = None if r.random() < 0.02 else at(second + fraction)
        out.append({"cc_num": user, "trans_date_trans_time": time})
    # A third of the rows at one instant.
    out += [{"cc_num": 0, "trans_date_trans_time": at(50)} for _ in range(450)]
    return out


def ordered(data):
    users = {}
    for i, row in enumerate(data):
        if row["trans_date_trans_time"] is not None:
            users.setdefault(row["cc_num"], []).append((row["trans_date_trans_time"], f"t{i:05d}"))
    return {u: sorted(v) for u, v in users.items()}


def gap(a, b, exact):
    if exact:
        return (b - a).total_seconds()
    return int((b.replace(microsecond=0) - a.replace(microsecond=0)).total_seconds())


@pytest.mark.parametrize("mode", ["seconds", "exact"])
@pytest.mark.parametrize("limit", [1, 60, 600, 100000])
def test_short_gaps_against_brute_force(spark, mode, limit):
    data = random_rows(limit)
    expected = {}
    for user, seq in ordered(data).items():
        expected[user] = sum(gap(a[0], b[0], mode == "exact") < limit for a, b in zip(seq, seq[1:]))
    got = short_gap_counts(frame(spark, data), Params(gap=mode, gap_seconds=limit))
    assert {r["cc_num"]: r["short_gaps"] for r in got.collect()} == {u: n for u, n in expected.items() if n}


@pytest.mark.parametrize("mode", ["seconds", "exact"])
def test_row_gaps_against_brute_force(spark, mode):
    data = random_rows(3)
    expected = Counter()
    for seq in ordered(data).values():
        expected[(seq[0][1], None)] += 1
        for a, b in zip(seq, seq[1:]):
            expected[(b[1], gap(a[0], b[0], mode == "exact"))] += 1
    for i, row in enumerate(data):
        if row["trans_date_trans_time"] is None:
            expected[(f"t{i:05d}", None)] += 1
    got = with_gaps(frame(spark, data), Params(gap=mode)).select("trans_num", "time_diff")
    assert Counter(map(tuple, got.collect())) == expected


@pytest.mark.parametrize("parts", [1, 5])
def test_one_row_of_an_instant_has_the_gap(spark, parts):
    # Copies of one transaction, and transactions without a number, at one instant.
    data = [{"cc_num": 1, "trans_date_trans_time": at(0), "trans_num": "a"}]
    data += [{"cc_num": 1, "trans_date_trans_time": at(300), "trans_num": n} for n in ("b", "b", None, None, "c")]
    data += [{"cc_num": 1, "trans_date_trans_time": at(900), "trans_num": "d"} for _ in range(40)]
    data += [{"cc_num": None, "trans_date_trans_time": at(5 * i), "trans_num": None} for i in (0, 0, 1)]
    df = frame(spark, data).repartition(parts)
    got = Counter((r["cc_num"], r["trans_num"], r["time_diff"]) for r in with_gaps(df).collect())
    assert got == Counter(
        {
            (1, "a", None): 1, (1, None, 300): 1, (1, None, 0): 1, (1, "b", 0): 2, (1, "c", 0): 1,
            (1, "d", 600): 1, (1, "d", 0): 39, (None, None, None): 1, (None, None, 0): 1, (None, None, 5): 1,
        }
    )


@pytest.mark.parametrize("partitions", [1, 3, 40])
def test_times_are_carried_over_any_borders(spark, partitions):
    """A user may fill many partitions, some of them with missing times only."""
    data = random_rows(partitions) + [{"cc_num": 2, "trans_date_trans_time": None} for _ in range(300)]
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = Counter((r["trans_num"], r["time_diff"]) for r in with_gaps(frame(spark, data)).collect())
        ranges = user_time_ranges(frame(spark, data))
        assert partitions == 1 or ranges.select("__part").distinct().count() > partitions // 2
        assert carried_times(ranges).count() < max(2, partitions)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    names = [f"t{i:05d}" for i in range(len(data))]
    users = {}
    for name, row in zip(names, data):
        users.setdefault(row["cc_num"], []).append((row["trans_date_trans_time"], name))
    expected = Counter()
    for own in users.values():
        previous = None
        for t, name in sorted((x for x in own if x[0] is not None)):
            gap = None if previous is None else int(t.replace(microsecond=0).timestamp() - previous.replace(microsecond=0).timestamp())
            expected[name, gap] += 1
            previous = t
        expected.update((name, None) for t, name in own if t is None)
    assert got == expected


def test_a_third_of_the_rows_without_user_time_and_id(spark):
    """Hot rows with nothing to tell them apart still spread evenly."""
    n = 30_000
    hot = F.col("id") % 3 == 0
    df = spark.range(n).select(
        F.when(~hot, F.col("id") % 50).alias("cc_num"),
        F.when(~hot, F.col("id").cast("string")).alias("trans_num"),
        F.when(~hot, F.timestamp_seconds(F.col("id"))).cast("timestamp_ntz").alias("trans_date_trans_time"),
    )
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = [r["count"] for r in user_time_ranges(df).groupBy("__part").count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert len(sizes) == 8 and max(sizes) < 1.5 * n / 8
    got = with_gaps(df)
    assert got.count() == n and got.where("cc_num is null and time_diff is not null").count() == 0


def test_one_shuffle_after_the_ranges(spark, tmp_path):
    path = str(tmp_path / "rows")
    frame(spark, random_rows(1)).write.parquet(path)
    plan = with_gaps(spark.read.parquet(path))
    plan.collect()
    final = plan._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    # The window's, and two small ones of the carried times.
    assert final.count("Exchange hashpartitioning") <= 3 and "BroadcastNestedLoopJoin" not in final


@pytest.mark.parametrize("limit,m", [(1, 2), (60, 1), (60, 4), (600, 9), (3600, 30), (600, 451), (600, 600)])
def test_window_bursts_against_brute_force(spark, limit, m):
    data = random_rows(limit + m)
    expected = set()
    for user, seq in ordered(data).items():
        times = [t for t, _ in seq]
        if any((times[i] - times[i - m + 1]).total_seconds() <= limit for i in range(m - 1, len(times))):
            expected.add(user)
    params = Params(gap_seconds=limit, window_transactions=m, burst="window")
    got = window_burst_users(frame(spark, data), params)
    assert {r["cc_num"] for r in got.collect()} == expected


def test_edges(spark):
    params = Params(short_gaps=1)
    for seconds, hit in ((599, True), (600, False), (601, False)):
        df = frame(spark, [{"cc_num": 1, "trans_date_trans_time": at(s)} for s in (1000, 1000 + seconds)])
        assert bool(burst_users(df, params).count()) is hit
    # 599.2 s apart, but 600 whole seconds.
    df = frame(spark, [{"cc_num": 1, "trans_date_trans_time": at(s)} for s in (0.9, 600.1)])
    assert burst_users(df, params).count() == 0
    assert burst_users(df, replace(params, gap="exact")).count() == 1


@pytest.fixture()
def new_york(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    yield spark
    spark.conf.set("spark.sql.session.timeZone", before)


def test_local_times_ignore_clock_changes(new_york):
    # Clocks went from 2:00 to 3:00 that night; times without a zone are two seconds and an hour apart.
    times = [datetime(2024, 3, 10, 1, 59, 59, 500000), datetime(2024, 3, 10, 3, 0, 1, 500000)]
    df = frame(new_york, [{"cc_num": 1, "trans_date_trans_time": t} for t in times])
    assert rows(short_gap_counts(df)) == []
    assert {r["time_diff"] for r in with_gaps(df, Params(gap="exact")).collect()} == {None, 3602.0}
    zoned = df.withColumn("trans_date_trans_time", F.col("trans_date_trans_time").cast("timestamp"))
    assert rows(short_gap_counts(zoned)) == [(1, 1)]
    assert {r["time_diff"] for r in with_gaps(zoned).collect()} == {None, 2}


def test_before_1970(spark):
    df = frame(spark, [{"cc_num": 1, "trans_date_trans_time": at(-2_000_000_000 + s)} for s in (0, 10, 900)])
    assert rows(short_gap_counts(df)) == [(1, 1)]
    zero = frame(spark, [{"cc_num": 1, "trans_date_trans_time": at(s - 1704067200)} for s in (-599, 599)])
    assert rows(short_gap_counts(zero)) == []
    close = frame(spark, [{"cc_num": 1, "trans_date_trans_time": at(s - 1704067200)} for s in (-0.1, 0.1)])
    assert {r["time_diff"] for r in with_gaps(close, Params(gap="exact")).collect()} == {None, 0.2}


def test_bad_parameters():
    for bad in ({"gap_seconds": 0}, {"short_gaps": 0}, {"amount_quantile": 1.5}, {"span": "weeks"}):
        with pytest.raises(ValueError):
            Params(**bad)
