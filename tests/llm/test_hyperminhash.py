"""Near-duplicates against all pairs."""

import random

import numpy as np
import pytest
from brute import components, documents, edge_cases, sentence, shingles

from spendscope.llm import hyperminhash as hmh
from spendscope.llm.graph import components as connected
from spendscope.llm.words import U64, mix


def expected(rows, width, percent=80):
    place, sets = components([t for _, t in rows], width, percent)
    least = {}
    for (i, _), p in zip(rows, place):
        if i is not None:
            least[p] = min(i, least.get(p, i))
    out = [(i, len(s), least.get(p) if s else i) for (i, _), p, s in zip(rows, place, sets)]
    return sorted(out, key=repr), len({p for p, s in zip(place, sets) if s}) + sum(not s for s in sets)


@pytest.mark.parametrize("width,options", [(4, {}), (5, {"square": 3})])
def test_groups(spark, width, options):
    rows = edge_cases(width)
    got = hmh.near_groups(documents(spark, rows, 4), width=width, **options).collect()
    want, groups = expected(rows, width)
    assert sorted([(r.id, r.n_shingles, r.component_id) for r in got], key=repr) == want
    first = [r for r in got if r.first]
    assert len(first) == groups and all(r.id == r.component_id for r in first)


def test_links_between_texts_that_are_not_like_the_first(spark):
    # Chains whose ends are unlike share band buckets; links inside must not get lost.
    rng = random.Random(9)
    rows = []
    for c in range(6):
        words = sentence(rng, 150).split()
        for i in range(15):
            rows.append((c * 100 + rng.randrange(10**6) * 1000, " ".join(words)))
            words = words[:-4] if i % 2 else words[4:] + sentence(rng, 2).split()
    got = hmh.near_groups(documents(spark, rows), width=4).collect()
    assert sorted([(r.id, r.n_shingles, r.component_id) for r in got], key=repr) == expected(rows, 4)[0]


def test_near_dedup(spark):
    rows = edge_cases(2)
    docs = documents(spark, rows)
    got = hmh.near_dedup(docs).collect()
    place, sets = components([t for _, t in rows], 5, 80)
    groups = {p for p, s in zip(place, sets) if s}
    assert len(got) == len(groups) + sum(not s for s in sets)
    by_set = {s: p for p, s in zip(place, sets)}
    assert {by_set[shingles(r.text, 5)] for r in got if shingles(r.text, 5)} == groups
    assert hmh.near_dedup(docs.limit(0)).count() == 0


def test_estimate():
    rng = np.random.default_rng(0)
    errors = []
    for size in (2000, 300):
        for share in (0.0, 0.5, 0.8, 0.95):
            n = int(size * share)
            common, a, b = (mix(rng.integers(0, 1 << 62, k).astype(U64)) for k in (n, size - n, size - n))
            sets = [np.unique(np.concatenate([common, x])) for x in (a, b)]
            regs = hmh.registers(np.stack([hmh.minima(s) for s in sets]))
            estimate, used = hmh.similarity(regs[[0]], regs[[1]], np.array([size]), np.array([size]))
            errors.append((estimate[0] - n / (2 * size - n)) * np.sqrt(used[0]))
    assert max(map(abs, errors)) < 3 * 0.5


def test_components(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 101 + i) for i in range(50)] + [(rng.randrange(200, 260), rng.randrange(200, 260)) for _ in range(40)]
    found = {r.node: r.component for r in connected(spark.createDataFrame(edges, "a long, b long")).collect()}
    root = {i: i for e in edges for i in e}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in edges:
        root[find(a)] = find(b)
    nodes = {i for a, b in edges if a != b for i in (a, b)}
    assert set(found) == nodes
    assert len({(find(i), found[i]) for i in nodes}) == len({find(i) for i in nodes}) == len(set(found.values()))
    assert connected(spark.createDataFrame([], "a long, b long")).count() == 0


def test_empty(spark):
    assert hmh.near_groups(documents(spark, [])).count() == 0


def test_overlaps_are_exact():
    rng = np.random.default_rng(3)
    sets = [np.unique(np.concatenate([rng.integers(0, 90, 60), rng.integers(0, 10**6, rng.integers(0, 40))])) for _ in range(150)] + [np.zeros(0, int)]
    at = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
    rows, cols = np.arange(0, 151, 2), np.arange(1, 151, 2)
    for a, b in ((rows, cols), (rows, rows), (np.arange(151), np.arange(151))):
        got = hmh.overlaps(at, np.concatenate(sets), a, b)
        want = np.array([[len(np.intersect1d(sets[i], sets[j])) for j in b] for i in a])
        assert ((got == want) | (a[:, None] == b)).all()


def test_a_template_without_links(spark):
    """Many pages of one template, all just below the threshold: bounded work, no link but the planted one."""
    import time

    template = [f"t{i}" for i in range(404)]
    rows = [(i, " ".join([*template, *(f"p{i}x{k}" for k in range(80))])) for i in range(600)]
    rows.append((5000, rows[7][1] + " more"))
    start = time.perf_counter()
    got = {r.id: r.component_id for r in hmh.near_groups(documents(spark, rows), width=4, percent=80).collect()}
    assert time.perf_counter() - start < 60
    assert got == {i: (7 if i == 5000 else i) for i, _ in rows}
