"""Typed reads of transactions and run metrics."""

from __future__ import annotations

import logging
import re
from collections.abc import Callable

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendscope.schemas import RUN_METRICS, TRANSACTIONS

logger = logging.getLogger(__name__)

CSV_OPTIONS = {"header": True, "escape": '"'}
CORRUPT = "_corrupt_record"


def first_available(paths: tuple[str, ...], read: Callable[[str], DataFrame]) -> DataFrame:
    """Read the first path that can be opened.

    A missing path or an unknown host raises while the plan is built, before any data is read;
    errors in the data come later and are not hidden by another path.
    """
    for path in paths[:-1]:
        try:
            return read(path)
        except (PySparkException, Py4JError) as error:
            logger.warning("cannot open %s, trying the next path: %s", path, str(error).split("\n")[0])
    return read(paths[-1])


def read_csv(
    spark: SparkSession, *paths: str, schema: T.StructType = TRANSACTIONS, lenient: bool = False
) -> DataFrame:
    """Transactions from CSV with a header, from the first path that opens.

    Columns are matched by the header's names: known ones get their type, others stay text,
    and known ones that the file lacks are simply absent. Only the header is read up front.
    Times are read as text and then cast, which accepts any number of fraction digits.

    A line with too few or too many values raises, and a value that cannot be read does when
    its column is used. With ``lenient`` values are NULL instead, and ``_corrupt_record`` holds
    the line or the first bad value, so that such rows can be counted and taken out: see
    ``split_corrupt``.
    """
    types = {f.name: f.dataType for f in schema.fields}
    times = [n for n, t in types.items() if isinstance(t, (T.TimestampNTZType, T.TimestampType))]

    def read(path: str) -> DataFrame:
        names = spark.read.options(**CSV_OPTIONS).csv(path).columns
        # The lenient way casts every column by itself, so that a bad value shows up in the
        # extra column whichever columns are used.
        text = set(names) if lenient else {*times, *(n for n in names if n not in types)}
        fields = [T.StructField(n, T.StringType() if n in text else types[n]) for n in names]
        # Every file's header is checked, unless a column without a name makes that impossible.
        unnamed = any(re.fullmatch(r"_c\d+", n) for n in names)
        if lenient:
            fields.append(T.StructField(CORRUPT, T.StringType()))
        rows = (
            spark.read.schema(T.StructType(fields))
            .options(**CSV_OPTIONS, enforceSchema=unnamed, columnPruning=False)
            .options(mode="PERMISSIVE" if lenient else "FAILFAST", columnNameOfCorruptRecord=CORRUPT)
            .csv(path)
        )
        found = [n for n in names if n in types] if lenient else [n for n in times if n in names]
        if lenient:
            bad = [F.when(F.col(n).isNotNull() & F.col(n).try_cast(types[n]).isNull(), F.col(n)) for n in found]
            rows = rows.withColumn(CORRUPT, F.coalesce(F.col(CORRUPT), *bad))
        cast = {n: F.col(n).try_cast(types[n]) if lenient else F.col(n).cast(types[n]) for n in found}
        return rows.withColumns(cast) if cast else rows

    return first_available(paths, read)


def split_corrupt(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows read with ``lenient``: the good ones without the extra column, and the bad ones with it."""
    return rows.where(F.col(CORRUPT).isNull()).drop(CORRUPT), rows.where(F.col(CORRUPT).isNotNull())


def read_csv_inferred(spark: SparkSession, *paths: str) -> DataFrame:
    """CSV with inferred types, at the price of one more pass over the data."""
    return first_available(paths, lambda p: spark.read.options(**CSV_OPTIONS, inferSchema=True).csv(p))


def read_parquet(spark: SparkSession, *paths: str) -> DataFrame:
    return first_available(paths, spark.read.parquet)


def read_metrics_json(spark: SparkSession, path: str, documents: bool = False) -> DataFrame:
    """Nested run metrics; absent keys become NULL.

    ``documents`` reads files that hold one document over several lines; otherwise each line
    is a record, which lets Spark split large files.
    """
    return spark.read.schema(RUN_METRICS).option("multiLine", documents).json(path)


def read_metrics_text(spark: SparkSession, path: str) -> DataFrame:
    """``key=value`` text files, one run per file named ``metrics_<experiment>.txt``, or per
    ``experiment=...`` folder.

    The last line of a key counts; a value that is no number is NULL.
    """
    key, number = F.split("value", "=")[0], F.trim(F.try_element_at(F.split("value", "="), F.lit(2)))
    text = spark.read.text(path)
    if "experiment" in text.columns:
        experiment = F.col("experiment").cast("string")
    else:
        experiment = F.regexp_extract(F.col("_metadata.file_name"), r"^(?:metrics_)?(.*)\.txt$", 1)
    lines = text.select(
        experiment.alias("experiment"),
        key.alias("key"),
        number.alias("number"),
        # Position in the file: the block, then the order within it.
        F.struct("_metadata.file_block_start", F.monotonically_increasing_id()).alias("position"),
    )

    def last(name: str, type_name: str):
        wanted = F.when(F.col("key") == name, F.col("position"))
        return F.max_by(F.col("number"), wanted).try_cast(type_name)

    return lines.groupBy("experiment").agg(
        last("execution_time_sec", "double").alias("execution_time"),
        last("rows_processed", "bigint").alias("rows_processed"),
    )
