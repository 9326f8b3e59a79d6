"""The corpus pipeline: each stage against plain Python on its own input."""

import re
from collections import Counter, defaultdict

import pytest
from brute import components, documents, edge_cases, without_repeats

import corpus_pipeline

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """Input and output of each stage, as rows."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = []
    for name, stage in corpus_pipeline.STAGES:
        path = f"{spark.conf.get('spark.checkpoint.dir')}/test-{name.replace(' ', '-')}"
        stage(spark, docs, SF).write.mode("overwrite").parquet(path)
        after = spark.read.parquet(path)
        out.append((docs, after))
        docs = after
    return {name: pair for (name, _), pair in zip(corpus_pipeline.STAGES, out)}


def test_columns(stages):
    for name, (before, after) in stages.items():
        if name != "packing":
            assert after.dtypes == before.dtypes


def test_toxicity(spark, stages):
    before, after = stages["toxicity"]
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = {r.doc_id for r in after.collect()}
    clean = [i for i, toxic in labels.items() if not toxic]
    assert sum(i in kept for i in clean) >= 0.98 * len(clean)
    named = re.compile(r"\b(trash|pathetic|idiot|worthless|disgusting|stupid|clown|scum|loser|moron)\b", re.I)
    insulting = {r.doc_id for r in before.collect() if len(named.findall(r.text or "")) >= 3}
    assert len(insulting) > 5 and len(insulting & kept) <= 0.2 * len(insulting)
    assert {tuple(r) for r in after.collect()} <= {tuple(r) for r in before.collect()}


def test_exact(stages):
    before, after = (x.collect() for x in stages["exact dedup"])
    last = {}
    for r in before:
        last[r.text] = max(r.doc_id, last.get(r.text, r.doc_id))
    assert sorted(r.doc_id for r in after) == sorted(last.values())


def test_near(stages):
    before, after = (x.collect() for x in stages["near dedup"])
    place, sets = components([r.text for r in before], 5, 80)
    least = {}
    for r, p in zip(before, place):
        least[p] = min(r.doc_id, least.get(p, r.doc_id))
    empty = [r.doc_id for r, s in zip(before, sets) if not s]
    full = {least[p] for p, s in zip(place, sets) if s}
    assert sorted(r.doc_id for r in after) == sorted([*full, *empty])


def test_substrings(stages):
    before, after = (x.collect() for x in stages["substring dedup"])
    words, kept = without_repeats([r.text for r in before], 35)
    want = {r.doc_id: r.text if len(w) == len(k) else " ".join(k) for r, w, k in zip(before, words, kept)}
    assert {r.doc_id: r.text for r in after} == want
    assert all(r.n_chars == len(r.text or "") for r in after)


def test_packing(stages):
    before, after = (x.collect() for x in stages["packing"])
    assert {r.doc_id for r in before} == {r.doc_id for r in after}
    sequences = defaultdict(list)
    for r in after:
        sequences[r.sequence_id].append((r.offset, r.length))
    for own in sequences.values():
        assert [o for o, _ in sorted(own)] == [sum(n for o, n in own if o < at) for at, _ in sorted(own)]
    total = Counter()
    for r in after:
        total[r.doc_id] += r.length
    assert all(total[r.doc_id] == r.doc_tokens for r in after)


def test_run(spark, stages):
    got = corpus_pipeline.run(spark, SF)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, stages["packing"][1].collect()))


def test_edge_cases(spark):
    docs = documents(spark, edge_cases())
    for name, stage in corpus_pipeline.STAGES[1:]:
        after = stage(spark, docs, SF)
        assert after.count() > 0 and stage(spark, docs.limit(0), SF).count() == 0
        if name != "packing":
            assert after.columns == docs.columns


def test_oracle_is_none():
    assert corpus_pipeline.ORACLE_SQL is None and [re.sub(" .*", "", n) for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact", "near", "substring", "packing"]
