"""Fixed input schemas, so that no read pays for schema inference."""

from __future__ import annotations

from pyspark.sql import types as T

TRANSACTIONS = T.StructType(
    [
        T.StructField("trans_num", T.StringType()),
        T.StructField("cc_num", T.LongType()),
        T.StructField("trans_date_trans_time", T.TimestampNTZType()),
        T.StructField("category", T.StringType()),
        T.StructField("merchant", T.StringType()),
        T.StructField("amt", T.DoubleType()),
        T.StructField("lat", T.DoubleType()),
        T.StructField("long", T.DoubleType()),
        T.StructField("merch_lat", T.DoubleType()),
        T.StructField("merch_long", T.DoubleType()),
        T.StructField("state", T.StringType()),
        T.StructField("gender", T.StringType()),
        T.StructField("job", T.StringType()),
        # The label is readable but no operator uses it.
        T.StructField("is_fraud", T.IntegerType()),
    ]
)


def _ints(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.IntegerType()) for n in names])


RUN_METRICS = T.StructType(
    [
        T.StructField("experiment_name", T.StringType()),
        T.StructField("optimized", T.BooleanType()),
        T.StructField("timestamp", T.StringType()),
        T.StructField("total_execution_time_sec", T.DoubleType()),
        T.StructField("stages", T.MapType(T.StringType(), T.DoubleType())),
        T.StructField(
            "memory_allocated",
            _ints("driver_memory_mb", "executor_memory_mb", "total_executor_memory_mb", "num_executors"),
        ),
        T.StructField(
            "memory_used",
            _ints(
                "driver_total_mb",
                "driver_used_mb",
                "driver_free_mb",
                "executors_total_mb",
                "executors_used_mb",
                "executors_free_mb",
            ),
        ),
        T.StructField(
            "job_statistics",
            _ints(
                "num_jobs",
                "num_completed_jobs",
                "num_failed_jobs",
                "num_stages",
                "num_completed_stages",
                "num_tasks_launched",
                "num_tasks_completed",
                "num_tasks_failed",
            ),
        ),
        T.StructField("rows_processed", T.LongType()),
    ]
)
