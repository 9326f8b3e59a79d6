"""Packing: every id of the tokenizer in one place, windows without gaps, little padding."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from brute import documents, edge_cases, sentence

from spendscope.llm import packing
from spendscope.llm.queries import tokenizer_path

PATH = tokenizer_path("word_bpe_49k.json")
NASTY = [
    "don't stop, it's 3.14... end.", "x<|endoftext|>y <|STARTOFTEXT|> Z<|startoftext|>.", "a\x1cb\x85c d e", "é É. ﬁ Ａ１, İstanbul",
    "日本語テキスト。 한국어, 'S 's. 9.", ".", ",,", "a.", "..a.", "-.", "x'.", "é.", "K.", "🙂🙂.", "A.B,C. d,", "x" * 3000, " ".join(["Go."] * 50),
]


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


def check(rows, got, tokenizer, capacity=packing.CAPACITY, ids=True):
    docs, sequences = defaultdict(list), defaultdict(list)
    for r in got:
        docs[r.number].append(r)
        sequences[r.sequence_id].append((r.offset, r.length))
    for own in sequences.values():
        end = 0
        for offset, length in sorted(own):
            assert offset == end
            end += length
        assert end <= capacity
    want = sorted((repr(i), tuple([*tokenizer.encode(t or "", add_special_tokens=False).ids, 2])) for i, t in rows)
    have = []
    for own in docs.values():
        own.sort(key=lambda r: r.start)
        whole = [x for r in own for x in r.ids]
        assert [r.start for r in own] == list(range(0, len(whole), capacity))
        for r in own:
            assert r.length == len(r.ids) and r.doc_tokens == len(whole)
            assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        have.append((repr(own[0].id), tuple(whole)))
    assert sorted(have) == want
    return sequences


@pytest.mark.parametrize("options", [{}, {"capacity": 64, "shard_pieces": 40}])
def test_pieces_and_sequences(spark, tokenizer, options):
    rows = edge_cases() + [(1000 + i, t) for i, t in enumerate(NASTY)] + [(1, " ".join(NASTY))]
    cut = packing.pieces(documents(spark, rows), PATH, capacity=options.get("capacity", 4096), with_ids=True)
    check(rows, packing.packed(cut, **options).collect(), tokenizer, options.get("capacity", 4096))


def test_little_padding(spark):
    rng = random.Random(3)
    rows = [(i, sentence(rng, rng.randrange(1, 900))) for i in range(1500)]
    got = packing.packed(packing.pieces(documents(spark, rows), PATH)).collect()
    used = sum(r.length for r in got)
    assert used / (4096 * len({r.sequence_id for r in got})) > 0.99


def test_tightest_window():
    rng = random.Random(0)
    windows, plain = packing.OpenWindows(100), []
    for n in range(3000):
        if rng.random() < 0.5:
            room = rng.randrange(0, 101)
            windows.put(room, n)
            if room:
                plain.append(room)
        else:
            need = rng.randrange(1, 101)
            fits = [r for r in plain if r >= need]
            found = windows.take(need)
            assert (found and found[0]) == (min(fits) if fits else None)
            if fits:
                plain.remove(min(fits))


def test_memory_of_words_is_bounded(monkeypatch, tokenizer):
    import pyarrow as pa
    from spendscope.llm.words import PLAIN, split_words

    monkeypatch.setattr(packing, "REMEMBERED", 50)
    encoder, rng = packing.WordEncoder(PATH), random.Random(5)
    for _ in range(20):
        texts = [sentence(rng, 30) for _ in range(2)]
        (words,) = split_words(pa.array(texts), PLAIN)
        ids, at = encoder.encode(words)
        for i, t in enumerate(texts):
            assert ids[at[i] : at[i + 1]].tolist() == tokenizer.encode(t, add_special_tokens=False).ids
    assert len(encoder.known) <= 110


def test_empty(spark):
    assert packing.packed(packing.pieces(documents(spark, []), PATH)).count() == 0
