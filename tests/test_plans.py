"""Shapes of the physical plans, and the whole analysis."""

import os
import re

import pytest
from conftest import SF_SMALL
from helpers import rows

from spendscope import session
from spendscope.operators import criteria, gaps, profiles, segments, stats
from spendscope.operators.features import with_features
from spendscope.params import Params
from spendscope.plans import analyse, load
from spendscope.plans.queries import REGISTRY, TUNED
from spendscope.sources.sinks import write_csv
from spendscope.sources.testdata import table, transactions


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def scans(text):
    return re.findall(r"ReadSchema: struct<([^>]*)>", text)


def scans_of(df, path):
    """How often the plan reads files below ``path``; plan text cuts long paths."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    found = [leaves.apply(i) for i in range(leaves.size())]
    return sum(path in f.relation().location().rootPaths().mkString() for f in found if "Relation" in f.toString())


@pytest.fixture(scope="module")
def tx(spark):
    return with_features(transactions(spark, SF_SMALL), TUNED)


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_no_python_and_no_cartesian(spark, name):
    text = plan(REGISTRY[name](spark, SF_SMALL))
    assert not re.search(r"Python|Pandas|CartesianProduct", text)
    # Nested loops only where one side is a single row: the bracket of a quantile, or totals.
    loops = re.findall(r"BroadcastNestedLoopJoin.*", text)
    assert len(loops) <= 12


def test_columns_are_pruned(spark, tx):
    frequent = criteria.high_frequency(profiles.user_totals(tx, TUNED), TUNED)
    assert scans(plan(frequent)) == ["event_id:bigint,ts:timestamp_ntz,user_id:bigint"]
    assert scans(plan(gaps.short_gap_counts(tx, TUNED))) == ["ts:timestamp_ntz,user_id:bigint"]


def test_filters_reach_the_scan(spark, tx):
    assert "PushedFilters: [IsNotNull(ts)]" in plan(gaps.short_gap_counts(tx, TUNED))


def test_totals_need_one_shuffle_of_partial_aggregates(tx):
    text = plan(profiles.user_totals(tx, TUNED))
    assert text.count("Exchange") == 1 and "partial_sum" in text and "Expand" not in text


def test_short_gaps_need_no_sort(tx):
    text = plan(gaps.short_gap_counts(tx, TUNED))
    assert "Window" not in text and "Sort" not in text
    assert text.count("Exchange") == 2


def test_comparison_joins_after_aggregating(spark, tx):
    users = table(spark, SF_SMALL, "customer").selectExpr("c_custkey AS cc_num")
    text = plan(segments.compare_by(tx, users, "category", TUNED))
    below_join = text[text.index("Join") :]
    assert "partial_count" in below_join


def test_ways_of_keeping_agree(spark, tx):
    rows_ = transactions(spark, SF_SMALL, with_state=True)
    table_kept = analyse(rows_, TUNED)
    memory_kept = analyse(rows_, TUNED, keep="memory", cache_features=True, partitions=3)
    with table_kept, memory_kept:
        assert rows(table_kept.flags) == rows(memory_kept.flags) == rows(criteria.flag_users(tx, TUNED))
        assert rows(table_kept.comparison) == rows(memory_kept.comparison)
        assert {r["dimension"] for r in table_kept.comparison.collect()} == set(segments.DIMENSIONS)
        assert memory_kept.transactions.is_cached and memory_kept.profiles.is_cached
    assert not memory_kept.transactions.is_cached and not memory_kept.profiles.is_cached


def test_analysis_statistics_equal_the_direct_ones(spark):
    rows_ = transactions(spark, SF_SMALL, with_state=True)
    done = analyse(rows_, TUNED, keep="nothing")
    direct = with_features(rows_, TUNED)
    for got, expected in (
        (done.category_stats, stats.category_stats_extended(direct, TUNED)),
        (done.hourly_stats, stats.hourly_stats(direct, TUNED)),
        (done.state_stats, stats.state_stats(direct, TUNED)),
        (done.profiles, profiles.user_profiles(direct, TUNED)),
        (done.comparison, segments.compare_segments(direct, done.users, segments.DIMENSIONS, TUNED)),
    ):
        assert sorted(got.columns) == sorted(expected.columns)
        assert dict(got.dtypes) == dict(expected.dtypes)
        if got is not done.profiles:
            assert rows(got.select(expected.columns)) == rows(expected)


def test_analysis_of_nothing(spark):
    for keep in ("table", "memory", "nothing"):
        with analyse(transactions(spark, SF_SMALL, with_state=True).limit(0), TUNED, keep=keep) as done:
            assert done.flags.count() == done.users.count() == done.comparison.count() == 0
            assert tuple(done.row_share.first()) == (0, 0, 0.0)


def test_analysis_reads_the_source_four_times(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "rows")
    transactions(spark, SF_SMALL, with_state=True).write.parquet(path)
    source = spark.read.parquet(path)
    passes = []
    real = session.stored

    def counted(df, name):
        passes.append((name, scans_of(df, path)))
        return real(df, name)

    for module in ("spendscope.plans.analysis", "spendscope.operators.quantiles"):
        monkeypatch.setattr(f"{module}.stored", counted)
    with analyse(source, TUNED) as done:
        read = [name for name, n in passes if n]
        assert read == ["totals", "category_amounts", "profiles", "flags"] and sum(n for _, n in passes) == 4
        # Everything else comes from the stored tables.
        for name in ("category_stats", "hourly_stats", "state_stats", "profiles", "flags", "users", "summary",
                     "row_share", "comparison", "top_categories", "peak_hour", "over_represented"):
            assert not any(path in f for f in getattr(done, name).inputFiles()), name
    with analyse(source, TUNED, keep="nothing") as lazy:
        for name in ("row_share", "comparison", "hourly_stats"):
            assert any(path in f for f in getattr(lazy, name).inputFiles())


def test_scratch_tables_go(spark):
    mark = session.scratch_mark()
    with analyse(transactions(spark, SF_SMALL), TUNED) as done:
        assert done.summary.count() > 0
        paths = [p.removeprefix("file:") for p in session._written[mark:]]
        assert len(paths) >= 5 and all(os.path.exists(p) for p in paths)
    assert not any(os.path.exists(p) for p in paths) and session.scratch_mark() == mark


def test_landing(spark, tmp_path):
    write_csv(transactions(spark, SF_SMALL), str(tmp_path / "rows.csv"))
    landed = load(spark, str(tmp_path / "rows.csv"), landing=str(tmp_path / "landed"))
    assert "FileScan parquet" in plan(landed)
    assert rows(landed) == rows(load(spark, str(tmp_path / "rows.csv")))


def test_analysis_is_written(spark, tmp_path):
    done = analyse(transactions(spark, SF_SMALL), TUNED)
    assert done.state_stats is None
    done.write(str(tmp_path))
    back = load(spark, str(tmp_path / "absent"), str(tmp_path / "users"))
    assert rows(back) == rows(done.users)
    assert not (tmp_path / "state_stats").exists()
    assert spark.read.parquet(str(tmp_path / "comparison")).count() > 0


def test_defaults_are_the_documented_ones():
    p = Params()
    assert (p.daily_rate, p.amount_quantile, p.distance_km, p.categories) == (120.0, 0.95, 150.0, 10)
    assert (p.gap_seconds, p.short_gaps) == (600, 5)


def test_command_line(spark, tmp_path, capsys):
    from spendscope.__main__ import main
    write_csv(transactions(spark, SF_SMALL, with_state=True), str(tmp_path / "transactions.csv"))
    main([
        "--input", str(tmp_path / "absent.csv"), str(tmp_path / "transactions.csv"), "--output", str(tmp_path / "out"),
        "--daily-rate", "2.7", "--distance-km", "153", "--categories", "25", "--gap-seconds", "3600",
        "--short-gaps", "9", "--amount-decimals", "2", "--cache-features", "--partitions", "4",
    ])
    assert "interesting: 4 of 15" in capsys.readouterr().out
    flags = spark.read.parquet(str(tmp_path / "out" / "flags"))
    expected = criteria.flag_users(with_features(transactions(spark, SF_SMALL)), TUNED)
    assert rows(flags.select(expected.columns)) == rows(expected)
    assert spark.read.parquet(str(tmp_path / "out" / "state_stats")).count() > 0
