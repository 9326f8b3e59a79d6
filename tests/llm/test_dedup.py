"""Exact dedup against plain Python."""

import numpy as np
import pytest
from brute import documents, edge_cases, sha
from hypothesis import given
from hypothesis import strategies as st

from spendscope.llm import dedup


@given(st.sets(st.integers(0, 1 << 40), max_size=300), st.integers(0, 1 << 10))
def test_golomb_round_trip(values, more):
    values = np.array(sorted(values), np.int64)
    span = int(values[-1]) + 1 + more if len(values) else 1
    assert dedup.golomb_decode(dedup.golomb_encode(values, span)).tolist() == values.tolist()


def test_golomb_is_small():
    values = np.unique(np.random.default_rng(0).integers(0, 1 << 48, 1 << 16))
    assert len(dedup.golomb_encode(values, 1 << 48)) < 4.5 * len(values)


def expected(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(t or "", []).append(i)
    out = []
    for i, t in rows:
        ids = groups[t or ""]
        known = [x for x in ids if x is not None]
        out.append((i, max(known) if known else None, len(ids), sha(t or "")))
    return sorted(out, key=repr)


@pytest.mark.parametrize("options", [{}, {"owners": 1, "fingerprint_bits": 4}, {"owners": 7, "block_rows": 5}])
def test_groups(spark, options):
    rows = edge_cases()
    got = dedup.exact_dedup(documents(spark, rows, 4), **options).collect()
    assert sorted([(r.id, r.keep_id, r.group_size, r.sha.hex()) for r in got], key=repr) == expected(rows)
    kept = [(r.id, r.sha) for r in got if r.kept]
    assert len(kept) == len({r.sha for r in got})  # one row of each group, also among repeated rows
    assert all(r.id == r.keep_id for r in got if r.kept)
    assert all(r.doc.kept.startswith("kept ") and r.doc.doc_id == r.id for r in got)


def test_deduplicated(spark):
    rows = edge_cases(1)
    docs = documents(spark, rows)
    got = dedup.deduplicated(docs)
    assert got.columns == docs.columns
    assert sorted((r.text or "") for r in got.collect()) == sorted({t or "" for _, t in rows})


def test_empty(spark):
    assert dedup.exact_dedup(documents(spark, [])).count() == 0
