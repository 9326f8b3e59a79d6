import json
import os
from datetime import datetime

import pytest
from helpers import at, frame, rows
from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import functions as F

from spendscope.plans import load
from spendscope.operators.runmetrics import flatten_metrics, with_text_fallback
from spendscope.session import scratch_path, stored
from spendscope.sources import readers, sinks

HEADER = ",trans_date_trans_time,cc_num,merchant,category,amt,first,state,lat,long,merch_lat,merch_long,trans_num"
LINE = '0,2021-05-06 07:08:09,4000123412341234,"Baker, Sons",groceries,4.97,Kim,OR,44.05,-121.31,44.9,-122.04,a1b2'


@pytest.fixture()
def csv_file(tmp_path):
    path = tmp_path / "transactions.csv"
    path.write_text(f"{HEADER}\n{LINE}\n")
    return str(path)


def test_csv_is_matched_by_header_names(spark, csv_file):
    row = readers.read_csv(spark, csv_file).first().asDict()
    assert row["cc_num"] == 4000123412341234 and row["amt"] == 4.97
    assert row["merchant"] == "Baker, Sons" and row["first"] == "Kim"
    assert row["trans_date_trans_time"] == datetime(2021, 5, 6, 7, 8, 9)
    assert "job" not in row


def test_csv_bad_time(spark, tmp_path):
    path = tmp_path / "bad.csv"
    path.write_text("cc_num,trans_date_trans_time\n1,never\n")
    assert readers.read_csv(spark, str(path), lenient=True).first()["trans_date_trans_time"] is None
    with pytest.raises(PySparkException):
        readers.read_csv(spark, str(path)).collect()


def test_csv_bad_values(spark, tmp_path):
    path = tmp_path / "bad.csv"
    good = "1,2021-05-06 07:08:09,4.97,a"
    bad = ['2,2021-05-06 07:08:09,"1,250.00",b', "x,2021-05-06 07:08:09,1.0,c", "3,2021-05-06", "4,never,1.0,d"]
    header = "cc_num,trans_date_trans_time,amt,trans_num"
    for line in bad:
        path.write_text("\n".join([header, good, line]) + "\n")
        with pytest.raises((PySparkException, Py4JJavaError)):
            readers.read_csv(spark, str(path)).collect()
    path.write_text("\n".join([header, good, *bad]) + "\n")
    read = readers.read_csv(spark, str(path), lenient=True)
    fine, corrupt = readers.split_corrupt(read)
    assert [r["trans_num"] for r in fine.collect()] == ["a"] and readers.CORRUPT not in fine.columns
    assert corrupt.count() == corrupt.select("trans_num").count() == 4
    shown = {r["trans_num"]: r for r in corrupt.collect()}
    assert shown["b"]["amt"] is None and shown["c"]["cc_num"] is None and shown["d"]["trans_date_trans_time"] is None
    assert load(spark, str(path), lenient=True).count() == 1


def test_fallback(spark, csv_file):
    assert readers.read_csv(spark, "/nowhere/a.csv", "/nowhere/b.csv", csv_file).count() == 1
    assert readers.read_csv(spark, "hdfs://no-such-host:9000/a.csv", csv_file).count() == 1
    assert readers.read_csv_inferred(spark, "/nowhere/a.csv", csv_file).first()["cc_num"] == 4000123412341234
    with pytest.raises(AnalysisException):
        readers.read_csv(spark, "/nowhere/a.csv", "/nowhere/b.csv")
    with pytest.raises(AnalysisException):
        readers.read_parquet(spark, "/nowhere/a", "/nowhere/b")


def test_rows_by_user(spark, tmp_path):
    data = [{"cc_num": i % 3, "trans_date_trans_time": at(1000 - i)} for i in range(300)]
    df = frame(spark, data)
    sinks.write_by_user(df, str(tmp_path / "out"))
    back = readers.read_parquet(spark, str(tmp_path / "out"))
    assert rows(back) == rows(df)
    for part in (tmp_path / "out").glob("part-*"):
        keys = [(r["cc_num"], r["trans_date_trans_time"]) for r in spark.read.parquet(str(part)).collect()]
        assert keys == sorted(keys)


def test_copies_are_split_over_files(spark, tmp_path):
    copies = spark.range(0, 20000, 1, 4).selectExpr("7L AS cc_num", "TIMESTAMP_NTZ'2024-01-01' AS trans_date_trans_time")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sinks.write_by_user(copies, str(tmp_path / "out"))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    sizes = [spark.read.parquet(str(f)).count() for f in (tmp_path / "out").glob("part-*")]
    assert sum(sizes) == 20000 and max(sizes) < 10000


def test_csv_round_trip(spark, tmp_path):
    df = frame(
        spark,
        [
            {"cc_num": 1, "merchant": 'a "quoted", name', "amt": 0.1, "trans_date_trans_time": at(0.000001)},
            {"cc_num": None, "merchant": None, "amt": None, "trans_date_trans_time": None},
        ],
    )
    sinks.write_csv(df, str(tmp_path / "out"))
    assert rows(readers.read_csv(spark, str(tmp_path / "out"))) == rows(df)


def test_nested_columns_in_csv(spark, tmp_path):
    df = spark.sql("SELECT 'a' AS name, map('x', 1.5D) AS stages")
    sinks.write_csv(df, str(tmp_path / "out"))
    back = spark.read.options(**readers.CSV_OPTIONS).csv(str(tmp_path / "out")).first()
    assert json.loads(back["stages"]) == {"x": 1.5}


def test_metrics_documents_and_text(spark, tmp_path):
    full = {
        "experiment_name": "exp_1dn_base", "optimized": False, "total_execution_time_sec": 10.5,
        "stages": {"загрузка": 1.5}, "rows_processed": 7,
        "memory_allocated": {"driver_memory_mb": 1024, "num_executors": 1},
    }
    for name, content in {
        "exp_1dn_base": full, "exp_3dn_base": {"experiment_name": "exp_3dn_base", "rows_processed": 5},
        "exp_none": {"experiment_name": "exp_none"},
    }.items():
        (tmp_path / f"metrics_{name}.json").write_text(json.dumps(content, ensure_ascii=False, indent=2))
    (tmp_path / "metrics_exp_1dn_base.txt").write_text("execution_time_sec=99\nrows_processed=99\n")
    (tmp_path / "metrics_exp_3dn_base.txt").write_text(
        "execution_time_sec=1.0\nnoise\nexecution_time_sec= 2.5 \nrows_processed=oops\n"
    )
    (tmp_path / "metrics_exp_text.txt").write_text("rows_processed=3\nexecution_time_sec=4\n")
    metrics = readers.read_metrics_json(spark, str(tmp_path / "*.json"), documents=True)
    flat = flatten_metrics(metrics)
    assert {r["experiment"]: r["stages"] for r in flat.collect()}["exp_1dn_base"] == {"загрузка": 1.5}
    text = readers.read_metrics_text(spark, str(tmp_path / "*.txt"))
    joined = with_text_fallback(flat, text).select("experiment", "execution_time", "rows_processed")
    assert rows(joined) == [("exp_1dn_base", 10.5, 7), ("exp_3dn_base", 2.5, 5), ("exp_text", 4.0, 3)]


def test_json_keeps_text_readable(spark, tmp_path):
    sinks.write_json(spark.sql("SELECT 'этап' AS stage"), str(tmp_path / "out"))
    parts = [f for f in os.listdir(tmp_path / "out") if f.startswith("part")]
    assert any("этап" in (tmp_path / "out" / f).read_text() for f in parts)


def test_scratch(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark, "x").startswith(root)
    assert scratch_path(spark, "x") != scratch_path(spark, "x")
    df = spark.range(10).withColumn("b", F.col("id") * 2)
    assert rows(stored(df, "t")) == rows(df)
