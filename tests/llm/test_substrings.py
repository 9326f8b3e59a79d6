"""Removed passages against a count of all windows."""

import random

import numpy as np
import pytest
from brute import documents, edge_cases, without_repeats
from hypothesis import given
from hypothesis import strategies as st

from spendscope.llm import substrings


@pytest.mark.parametrize("options", [{}, {"shard_pieces": 1}, {"width": 9}])
def test_removed_words(spark, options):
    rows = edge_cases()
    rows += [(700 + i, "a b " * (20 + i)) for i in range(4)] + [(710, " ".join(["same"] * 200))]
    got = substrings.without_repeats(documents(spark, rows, 4), **options).collect()
    words, kept = without_repeats([t for _, t in rows], options.get("width", 35))
    want = [(i, len(w), len(w) - len(k), " ".join(k)) for (i, _), w, k in zip(rows, words, kept)]
    assert sorted([(r.doc.doc_id, r.n_words, r.n_removed, r.kept_text) for r in got], key=repr) == sorted(want, key=repr)


def test_many_pieces_around_one_passage(spark):
    rng = random.Random(4)
    text = lambda n: " ".join(f"v{rng.randrange(10**6)}" for _ in range(n))
    passage = text(45)
    rows = [(i, f"{text(rng.randrange(40))} {passage} {text(rng.randrange(40))}") for i in range(80)]
    words, kept = without_repeats([t for _, t in rows], 35)
    for shard_pieces in (8, 512):
        got = substrings.without_repeats(documents(spark, rows), carry=("doc_id",), shard_pieces=shard_pieces).collect()
        assert {r.doc.doc_id: r.kept_text for r in got} == {i: " ".join(k) for (i, _), k in zip(rows, kept)}


@given(st.lists(st.lists(st.integers(0, 2), max_size=14), min_size=1, max_size=5), st.lists(st.integers(1, 3), min_size=5, max_size=5))
def test_automaton(texts, weights):
    automaton = substrings.Automaton()
    for words, n in zip(texts, weights):
        automaton.add(words, n)
    automaton.sum_up()

    def occurs(run):
        return sum(n for t, n in zip(texts, weights) for i in range(len(t)) if t[i : i + len(run)] == run)

    for words in texts:
        want = [max((k for k in range(1, i + 2) if occurs(words[i + 1 - k : i + 1]) > 1), default=0) for i in range(len(words))]
        assert automaton.repeated(words) == want


def test_anchors():
    rng = np.random.default_rng(0)
    for width, run in ((35, 8), (9, 8), (8, 8), (20, 3)):
        hashes = rng.integers(0, 20, 100).astype(np.uint64)
        size = width - run + 1
        want = [i + int(np.argmin(hashes[i : i + size])) for i in range(len(hashes) - size + 1)]
        assert substrings.anchors(hashes, width, run).tolist() == want


def test_empty(spark):
    assert substrings.without_repeats(documents(spark, [])).count() == 0
