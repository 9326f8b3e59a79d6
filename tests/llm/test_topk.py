"""Exact top-k search against all inner products."""

import math

import numpy as np
from pyspark.sql import functions as F

from spendscope.llm import topk


def expected(rows, k):
    clean = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, a in clean:
        if q % 50 == 0:
            scores = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in clean if i != q)[:k]
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scores)]
    return sorted(out)


def test_against_all_pairs(spark):
    rng = np.random.default_rng(0)
    rows = [(i, rng.normal(0, 0.1, 16).tolist()) for i in range(300)]
    rows += [(400 + i, rows[7][1]) for i in range(60)]  # ties, and a common vector
    rows += [(500, None), (550, [None] * 16), (601, [float("nan")] * 16), (602, [float("inf")] + [0.0] * 15), (650, [0.5, -0.25]), (651, []), (None, rows[0][1]), (700, [-1.0] * 16)]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<double>, rank int").repartition(4)
    for options in ({}, {"lane_rows": 50, "chunk_rows": 3}):
        got = topk.top_k(df, F.col("vec_id") % 50 == 0, **options)
        assert sorted(tuple(r) for r in got.collect()) == expected(rows, 5)


def test_fewer_than_k_and_empty(spark):
    df = spark.createDataFrame([(0, [1.0]), (1, [2.0])], "vec_id long, embedding array<double>")
    assert [tuple(r) for r in topk.top_k(df, F.col("vec_id") == 0).collect()] == [(0, 1, 1, 256 * 512)]
    assert topk.top_k(df.limit(0), F.col("vec_id") == 0).count() == 0


def test_blocks_are_pruned():
    rng = np.random.default_rng(1)
    centre = rng.integers(-200, 200, (20, 8))
    docs = np.repeat(centre, 64, axis=0) + rng.integers(-5, 5, (1280, 8))
    best, ids, scored = topk.block_search(docs[::64], np.arange(0, 1280, 64), docs, np.arange(1280), 5, 64)
    assert scored < 0.5 * 20 * 20
    full = docs[::64] @ docs.T
    for q in range(20):
        full[q, 64 * q] = -(1 << 60)
        order = np.lexsort((np.arange(1280), -full[q]))[:5]
        assert ids[q].tolist() == order.tolist() and best[q].tolist() == full[q, order].tolist()


def test_numbers_too_large_for_floating_point():
    docs = np.array([[1 << 28, 1], [1 << 28, 2], [1 << 28, 3]], np.int64)
    best, ids, _ = topk.block_search(docs[:1], np.array([0]), docs, np.arange(3), 2, 1)
    assert ids.tolist() == [[2, 1]] and best.tolist() == [[(1 << 56) + 3, (1 << 56) + 2]]
