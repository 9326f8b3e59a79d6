"""Writers. Each writes a folder of part files, one per task; nothing passes the driver."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendscope.sources.readers import CSV_OPTIONS

# All six fraction digits, which the default format would cut to three.
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).parquet(path)


def write_set(tables: dict[str, DataFrame], path: str, optional: tuple[str, ...] = ()) -> None:
    """Several tables, each in a folder of its name below ``path``, published all at once.

    They are written to a new folder beside ``path``, which then takes its place by a rename; on file systems
    that rename folders in one step, readers see the old set or the new one. If writing
    fails, the new folder is removed and the old set stays. ``path`` must hold nothing but such
    a set (``optional`` names more tables that it may hold), as all of it is replaced.
    """
    spark = next(iter(tables.values())).sparkSession
    folder = spark._jvm.org.apache.hadoop.fs.Path
    target, mark = path.rstrip("/"), uuid.uuid4().hex
    new, old = f"{target}.{mark}-new", f"{target}.{mark}-old"
    fs = folder(target).getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.exists(folder(target)):
        held = {status.getPath().getName() for status in fs.listStatus(folder(target))}
        if other := held - set(tables) - set(optional):
            raise ValueError(f"{target} holds more than the tables that are written: {', '.join(sorted(other))}")
    try:
        for name, frame in tables.items():
            write_parquet(frame, f"{new}/{name}")
    except BaseException:
        fs.delete(folder(new), True)
        raise
    replaced = fs.exists(folder(target))
    if replaced and not fs.rename(folder(target), folder(old)):
        raise OSError(f"cannot move {target} away; the new tables are in {new}")
    if not fs.rename(folder(new), folder(target)):
        if replaced:
            fs.rename(folder(old), folder(target))
        raise OSError(f"cannot publish {new} as {target}")
    if replaced:
        fs.delete(folder(old), True)


def write_by_user(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Parquet in the order of user and time, split into files of about equal size.

    In such files a user's rows lie together, so aggregates per user shrink on the map side
    to about one row per user before they are shuffled. The ranges include the time and a
    row number, so that a heavy user, instant or group of copies is split over many files.
    """
    order = ("cc_num", "trans_date_trans_time")
    numbered = df.withColumn("row_number", F.monotonically_increasing_id())
    ranged = numbered.repartitionByRange(*order, "row_number").sortWithinPartitions(*order)
    write_parquet(ranged.drop("row_number"), path, mode)


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Nested rows as JSON records; text is written as it is, not escaped to ASCII."""
    df.write.mode(mode).json(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Flat rows with a header; map, array and struct columns are written as JSON text."""
    nested = (T.MapType, T.ArrayType, T.StructType)
    flat = df.select(
        *(
            F.to_json(f.name).alias(f.name) if isinstance(f.dataType, nested) else F.col(f.name)
            for f in df.schema.fields
        )
    )
    times = {"timestampNTZFormat": TIME_FORMAT, "timestampFormat": TIME_FORMAT}
    flat.write.mode(mode).options(**CSV_OPTIONS, **times).csv(path)


def write_metrics_text(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """``key=value`` lines, one folder per experiment (columns ``experiment`` and ``line``)."""
    df.write.mode(mode).partitionBy("experiment").text(path)
