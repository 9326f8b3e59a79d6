"""Arrow batches of bounded size."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator
from functools import wraps

import pyarrow as pa
from pyspark.sql import DataFrame

#: Rows and bytes of a batch of whole texts at most (a single longer text makes its own).
ROWS, BYTES = 1000, 4 << 20


def in_small_batches(df: DataFrame) -> DataFrame:
    """``df``, with its session set to hand small batches to Python.

    The default of 10,000 rows is tens of MB of texts for each task on either side. Spark reads the
    settings when a job starts, so they stay; a session that has lower ones keeps them.
    """
    conf = df.sparkSession.conf
    for key, limit in (("maxRecordsPerBatch", ROWS), ("maxBytesPerBatch", BYTES)):
        key = f"spark.sql.execution.arrow.{key}"
        own = conf.get(key)
        if not own.isdigit() or not 0 < int(own) <= limit:
            conf.set(key, str(limit))
    return df


def give_back() -> None:
    """Returns what this Python worker no longer uses to the system.

    Spark keeps workers for later tasks, and idle ones would hold on to their largest task's memory.
    """
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        pass  # another C library


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` over a task's batches, giving memory back when it is done."""

    @wraps(run)
    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        give_back()

    return wrapped
