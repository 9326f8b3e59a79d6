"""N-best segmentation against all segmentations, and exact round trips."""

import math
import random
import time

import numpy as np
import pytest
from brute import documents, edge_cases, sha

from spendscope.llm import nbest
from spendscope.llm.queries import tokenizer_path

PATH = tokenizer_path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def vocabulary():
    return nbest.Vocabulary(PATH)


def every_path(vocabulary, text):
    """Scores of all segmentations of a text, best first."""
    data = b" " + text if text else b""
    ways = [[] for _ in data] + [[]]
    ways[0] = [0]
    for end in range(1, len(data) + 1):
        if end < len(data) and data[end] & 0xC0 == 0x80:
            continue
        for start in range(end):
            if (found := vocabulary.piece.get(data[start:end])) and ways[start]:
                ways[end] += [w + found[0] for w in ways[start]]
        start = max(i for i in range(end) if data[i] & 0xC0 != 0x80)
        if data[start:end] not in vocabulary.piece:
            ways[end] += [w + vocabulary.byte_score * (end - start) for w in ways[start]]
        ways[end] = sorted(ways[end], reverse=True)[:50]
    return ways[-1]


TEXTS = ["", "a", "the", "the cat", "  two  spaces ", "\n", "a\n\nb", "日本語 text", "é\x00ß", "🙂", "unbelievable nonsense words", "x" * 90, "aaaa aaaa", "tab\tand\r\n", "    "]


@pytest.mark.parametrize("n", [1, 2, 3, 7])
def test_scores(vocabulary, n):
    rng = random.Random(n)
    texts = TEXTS + ["".join(rng.choice("abet ns\né") for _ in range(rng.randrange(1, 14))) for _ in range(60)]
    segmenter = nbest.Segmenter(PATH, n)
    for text, found in zip(texts, segmenter.texts([t.encode() for t in texts])):
        assert [s for s, _ in found] == every_path(vocabulary, text.encode())[:n], text
        assert len({tuple(ids) for _, ids in found}) == len(found)
        for score, ids in found:
            assert vocabulary.decode(np.array(ids, np.int64)).decode() == text
            names = [vocabulary.spelled[i] for i in ids]
            by_id = {i: s for s, i in vocabulary.piece.values()}
            assert score == sum(by_id.get(int(i), vocabulary.byte_score) for i in ids), names


def test_search_on_long_units(vocabulary):
    rng = random.Random(0)
    unit = b" " + "".join(rng.choice("abcdeé") for _ in range(200)).encode()
    short = nbest.SHORT
    at = np.array([0, len(unit)])
    score, loss, ids, _ = vocabulary.best(np.frombuffer(unit, np.uint8), at)
    found = vocabulary.search(unit, 2)
    assert len(unit) > short and score[0] == found[0][0] and loss[0] == found[0][0] - found[1][0]
    assert ids.tolist() == found[0][1]


def test_long_runs_take_linear_time(vocabulary):
    for run in (b"x" * 20_000, b"xy" * 10_000, b"=" * 20_000, b"ab" * 10_000):
        start = time.perf_counter()
        found = vocabulary.search(run, 3)
        assert time.perf_counter() - start < 3
        assert [s for s, _ in found] == sorted((s for s, _ in found), reverse=True) and len(found) == 3
        assert len({tuple(ids) for _, ids in found}) == 3


def test_length_of_a_unit_changes_nothing(vocabulary, monkeypatch):
    rng = random.Random(5)
    texts = ["".join(rng.choice("abx=-é") for _ in range(rng.randrange(1, 150))).encode() for _ in range(40)]
    want = list(nbest.Segmenter(PATH, 3).texts(texts))
    for short in (0, 10, 1000):
        monkeypatch.setattr(nbest, "SHORT", short)
        got = list(nbest.Segmenter(PATH, 3).texts(texts))
        assert [[(s, ids.tolist()) for s, ids in f] for f in got] == [[(s, ids.tolist()) for s, ids in f] for f in want]


def words_of(seed, n):
    rng = random.Random(seed)
    return sorted({b" " + "".join(rng.choice("etaoin shrdlu-".replace(" ", "")) for _ in range(rng.randrange(2, 13))).encode() for _ in range(n)})


def side_by_side(units):
    return np.frombuffer(b"".join(units), np.uint8), np.cumsum([0] + [len(u) for u in units])


def test_units_side_by_side(vocabulary):
    rng = random.Random(3)
    odd = ["".join(rng.choice("aet=-0é日🙂\x00ß") for _ in range(rng.randrange(1, 40))).encode() for _ in range(300)]
    units = [*odd, b" ", b"\n", "é".encode(), b" the", *words_of(4, 500)]
    rng.shuffle(units)
    raw, at = side_by_side(units)
    total, loss, ids, where = vocabulary.best(raw, at)
    for i, unit in enumerate(units):
        found = vocabulary.search(unit, 2)
        assert total[i] == found[0][0] and ids[where[i] : where[i + 1]].tolist() == found[0][1], unit
        assert loss[i] == (found[0][0] - found[1][0] if len(found) > 1 else -1), unit
    nothing = vocabulary.best(*side_by_side([]))
    assert [len(x) for x in nothing] == [0, 0, 0, 1]


def test_passes_on_arrays_are_cheap(vocabulary):
    units = words_of(6, 60_000)
    raw, at = side_by_side(units)

    def seconds(run):
        start = time.process_time()
        run()
        return time.process_time() - start

    on_arrays = min(seconds(lambda: vocabulary.best(raw, at)) for _ in range(3))
    one_by_one = min(seconds(lambda: [vocabulary.search(u, 2) for u in units[::30]]) for _ in range(3)) * 30
    assert on_arrays * 9 < one_by_one


def test_unfit_models_are_refused(monkeypatch):
    import sentencepiece

    real = sentencepiece.SentencePieceProcessor.id_to_piece
    monkeypatch.setattr(sentencepiece.SentencePieceProcessor, "id_to_piece", lambda self, i: "a▁b" if i == 500 else real(self, i))
    with pytest.raises(ValueError, match="border"):
        nbest.Vocabulary(PATH)


def test_query(spark):
    rows = edge_cases()
    got = nbest.n_best(documents(spark, rows), PATH, 3, with_ids=True).collect()
    best = [r for r in got if r.rank == 1]
    assert sorted([(r.id, r.decoded_sha256) for r in best], key=repr) == sorted([(i, sha(t or "")) for i, t in rows], key=repr)
    assert all(r.n_ids == len(r.ids) and math.isfinite(r.score) for r in got)
    for i, t in rows:
        if i == 605:
            own = sorted((r.rank, r.score) for r in got if r.id == i)
            want = every_path(nbest.Vocabulary(PATH), t.encode())[:3]
            assert [s for _, s in own] == [w / nbest.UNIT for w in want]


def test_memory_is_bounded(monkeypatch):
    monkeypatch.setattr(nbest, "REMEMBERED", 10)
    rng = random.Random(2)
    texts = [" ".join(str(rng.randrange(10**6)) for _ in range(8)) for _ in range(20)]
    segmenter = nbest.Segmenter(PATH, 2)
    want = [f for f in nbest.Segmenter(PATH, 2).texts([t.encode() for t in texts])]
    got = [next(iter(segmenter.texts([t.encode()]))) for t in texts]
    assert [[s for s, _ in f] for f in got] == [[s for s, _ in f] for f in want]
    assert len(segmenter.known) <= 20


def test_empty(spark):
    assert nbest.n_best(documents(spark, []), PATH).count() == 0
