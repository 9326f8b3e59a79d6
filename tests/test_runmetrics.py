import pytest
from helpers import by_key, rows

from spendscope.operators.runmetrics import (
    BASE,
    ONE_NODE,
    OPTIMIZED,
    SPEEDUPS,
    THREE_NODES,
    speedups,
    stage_rows,
    variant_ratio,
    with_labels,
    with_memory_total,
)


def test_labels(spark):
    df = spark.createDataFrame([("exp_1dn_base",), ("exp_3dn_optimized",)], "experiment string")
    got = by_key(with_labels(df), "experiment")
    assert tuple(got["exp_1dn_base"])[1:] == (ONE_NODE, 1, BASE)
    assert tuple(got["exp_3dn_optimized"])[1:] == (THREE_NODES, 3, OPTIMIZED)


def test_stage_rows(spark):
    df = spark.sql("SELECT 'e' AS experiment, map('a', 1D, 'b', 2D) AS stages UNION ALL SELECT 'f', NULL")
    assert rows(stage_rows(df)) == [("e", "a", 1.0), ("e", "b", 2.0)]


def test_published_speedups(spark):
    times = {"exp_1dn_base": 141.70, "exp_1dn_optimized": 98.37, "exp_3dn_base": 129.88, "exp_3dn_optimized": 96.68}
    df = spark.createDataFrame(list(times.items()), "experiment string, execution_time double")
    got = [round(r["speedup"], 2) for r in speedups(df).collect()]
    assert got == [1.44, 1.34, 1.09, 1.02]
    partial = speedups(df.where("experiment != 'exp_3dn_base'"))
    assert [r["metric"] for r in partial.collect()] == [SPEEDUPS[0][0], SPEEDUPS[3][0]]


def test_variant_ratio(spark):
    df = spark.createDataFrame(
        [("load", "base", 4.0), ("load", "optimized", 1.0), ("load", "optimized", 3.0), ("save", "base", 1.0)],
        "stage string, variant string, seconds double",
    )
    got = by_key(variant_ratio(df, "stage", "variant", "seconds", "base", "optimized"), "stage")
    assert (got["load"]["speedup"], got["load"]["improvement_pct"]) == (2.0, 50.0)
    assert (got["save"]["speedup"], got["save"]["improvement_pct"]) == (None, None)


@pytest.mark.parametrize("executors,expected", [(2048, 3072), (None, None)])
def test_memory_total(spark, executors, expected):
    df = spark.createDataFrame([(1024, executors)], "driver_memory_mb int, total_executor_memory_mb int")
    assert with_memory_total(df).first()["total_memory_mb"] == expected
