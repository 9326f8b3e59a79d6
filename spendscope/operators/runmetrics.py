"""Comparison of measured runs, over metrics tables of any size."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendscope.functions import ratio

# Labels derived from an experiment's name.
ONE_NODE = "1 DataNode"
THREE_NODES = "3 DataNodes"
OPTIMIZED = "Оптимизированная"
BASE = "Базовая"

# The four reported speed-ups as (metric, baseline, variant).
SPEEDUPS = (
    ("1DN Базовая vs Оптимизированная", "exp_1dn_base", "exp_1dn_optimized"),
    ("3DN Базовая vs Оптимизированная", "exp_3dn_base", "exp_3dn_optimized"),
    ("1DN vs 3DN (Базовая)", "exp_1dn_base", "exp_3dn_base"),
    ("1DN vs 3DN (Оптимизированная)", "exp_1dn_optimized", "exp_3dn_optimized"),
)


def with_labels(df: DataFrame, name: str = "experiment") -> DataFrame:
    """Cluster size and variant, read from the experiment's name."""
    one_node = F.col(name).contains("1dn")
    return df.withColumns(
        {
            "config": F.when(one_node, ONE_NODE).otherwise(THREE_NODES),
            "nodes": F.when(one_node, 1).otherwise(3),
            "optimization": F.when(F.col(name).contains("optimized"), OPTIMIZED).otherwise(BASE),
        }
    )


def flatten_metrics(metrics: DataFrame) -> DataFrame:
    """One flat row per run, with the memory columns taken from the key that is written."""
    return metrics.select(
        F.col("experiment_name").alias("experiment"),
        F.col("total_execution_time_sec").alias("execution_time"),
        "rows_processed",
        "memory_allocated.num_executors",
        "memory_allocated.driver_memory_mb",
        "memory_allocated.executor_memory_mb",
        "memory_allocated.total_executor_memory_mb",
        "stages",
    )


def with_text_fallback(flat: DataFrame, text: DataFrame) -> DataFrame:
    """Fill runs whose JSON has no time from the text files; drop runs without any time."""
    extra = text.withColumnsRenamed({"execution_time": "text_time", "rows_processed": "text_rows"})
    joined = flat.join(extra, "experiment", "full")
    no_time = F.col("execution_time").isNull()
    rows = F.when(no_time, F.coalesce("text_rows", "rows_processed")).otherwise(F.col("rows_processed"))
    return (
        joined.withColumns(
            {"rows_processed": rows, "execution_time": F.coalesce("execution_time", "text_time")}
        )
        .where(F.col("execution_time").isNotNull())
        .select(*flat.columns)
    )


def stage_rows(df: DataFrame, key: str = "experiment") -> DataFrame:
    """One row per run and stage."""
    return df.select(key, F.explode(F.map_entries("stages")).alias("entry")).select(
        key, F.col("entry.key").alias("stage"), F.col("entry.value").alias("seconds")
    )


def _value_of(label: Column, wanted: str, value: str) -> Column:
    return F.avg(F.when(label == wanted, F.col(value)))


def variant_ratio(
    df: DataFrame, key: str, variant: str, value: str, baseline: str, compared: str
) -> DataFrame:
    """Speed-up and improvement of one variant over another for each key.

    Several measurements of a variant are averaged. A missing side gives NULL.
    """
    measured = df.groupBy(key).agg(
        _value_of(F.col(variant), baseline, value).alias("baseline"),
        _value_of(F.col(variant), compared, value).alias("compared"),
    )
    return measured.withColumns(
        {
            "speedup": ratio(F.col("baseline"), F.col("compared")),
            "improvement_pct": improvement(F.col("baseline"), F.col("compared")),
        }
    )


def improvement(baseline: Column, variant: Column) -> Column:
    return (1 - ratio(variant, baseline)) * 100


def speedups(
    df: DataFrame,
    pairs: tuple[tuple[str, str, str], ...] = SPEEDUPS,
    name: str = "experiment",
    value: str = "execution_time",
) -> DataFrame:
    """The named speed-ups; a pair with a missing run is left out. One aggregate for all pairs."""
    runs = sorted({run for _, a, b in pairs for run in (a, b)})
    at = {run: F.col(f"run_{i}") for i, run in enumerate(runs)}
    measured = df.agg(
        *(_value_of(F.col(name), run, value).alias(f"run_{i}") for i, run in enumerate(runs))
    )
    entries = (
        F.struct(F.lit(metric).alias("metric"), ratio(at[a], at[b]).alias("speedup"))
        for metric, a, b in pairs
    )
    return measured.select(F.inline(F.array(*entries))).where(F.col("speedup").isNotNull())


def with_memory_total(
    df: DataFrame, columns: tuple[str, ...] = ("driver_memory_mb", "total_executor_memory_mb")
) -> DataFrame:
    """Sum of the memory columns; NULL where one is missing."""
    return df.withColumn("total_memory_mb", reduce(lambda a, b: a + b, (F.col(c) for c in columns)))
