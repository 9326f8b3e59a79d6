"""Small transaction tables for the unit tests."""

from datetime import datetime, timedelta

from pyspark.sql import types as T

from spendscope.schemas import TRANSACTIONS

START = datetime(2024, 1, 1)
NAMES = [f.name for f in TRANSACTIONS.fields]


def at(seconds: float) -> datetime:
    return START + timedelta(microseconds=round(seconds * 1_000_000))


def frame(spark, rows, drop=()):
    """Rows are dicts; missing columns are NULL, ids are filled in."""
    filled = []
    for i, row in enumerate(rows):
        full = {"trans_num": f"t{i:05d}", **row}
        filled.append(tuple(full.get(n) for n in NAMES))
    return spark.createDataFrame(filled, TRANSACTIONS).drop(*drop)


def numbers(spark, values, name="v"):
    return spark.createDataFrame([(v,) for v in values], T.StructType([T.StructField(name, T.DoubleType())]))


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def by_key(df, key):
    return {r[key]: r for r in df.collect()}
