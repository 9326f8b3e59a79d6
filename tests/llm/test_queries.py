"""Registered queries on text against their SQL counterparts."""

import duckdb
import pytest
from conftest import SF_CHECK

import __spark_entry__ as entry_points
from spendscope.llm.oracles import ORACLES
from spendscope.llm.queries import REGISTRY

TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


def test_registered():
    assert set(REGISTRY) | {"pipeline"} <= set(entry_points.queries())
    assert [int(n[2:].split("_")[0]) for n in REGISTRY] == list(range(1, 14))
    assert set(ORACLES) <= set(entry_points.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings", "pages", "labels", "conversations"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_CHECK}/{table}.parquet'")
    cursor = con.execute(ORACLES[name])
    names = [c[0] for c in cursor.description]
    got = REGISTRY[name](spark, SF_CHECK)
    assert sorted(got.columns) == sorted(names)
    assert {n: TYPES[t] for n, t in got.dtypes} == {c[0]: str(c[1]) for c in cursor.description}
    assert sorted(repr(tuple(r)) for r in got.select(*names).collect()) == sorted(map(repr, cursor.fetchall()))
