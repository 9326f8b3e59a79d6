"""Hashes of words and word sequences: equal where they should be, unequal on built patterns."""

import random

import numpy as np
import pyarrow as pa
import pytest
from brute import components, documents
from pyspark.sql import functions as F

from spendscope.llm import hyperminhash, nbest, packing, substrings
from spendscope.llm.queries import tokenizer_path
from spendscope.llm.words import LOWER, PLAIN, U64, bytes_hash, spans_hash, split_words, windows_hash

SWAP = str.maketrans("ab", "ba")


def thue_morse(n):
    """A word and its complement, which collide under any polynomial modulo a power of two."""
    word = "a"
    while len(word) < n:
        word += word.translate(SWAP)
    return word[:n], word[:n].translate(SWAP)


PAIRS = [thue_morse(n) for n in (1024, 2048, 4096, 8192)]


def test_patterns_do_not_collide():
    texts = [w for pair in PAIRS for w in pair]
    for split in (PLAIN, LOWER):
        hashes = np.concatenate([w.hash for w in split_words(pa.array(texts), split)])
        assert len(set(hashes.tolist())) == len(texts)
    for a, b in PAIRS:
        values = [np.array([5 if c == "a" else 1 << 63 for c in w], U64) for w in (a, b)]
        assert windows_hash(values[0], len(a))[0] != windows_hash(values[1], len(a))[0]


def test_hashes_follow_the_bytes():
    rng = random.Random(0)
    raw = np.frombuffer(bytes(rng.choice(b"ab") for _ in range(3000)), np.uint8)
    start = np.array([rng.randrange(2900) for _ in range(4000)])
    end = np.minimum(start + np.array([rng.randrange(0, 100) for _ in range(4000)]), 3000)
    values = raw.astype(U64)
    for hashes in (bytes_hash(raw, start, end), spans_hash(values, start, end)):
        named = {}
        for a, b, h in zip(start, end, hashes.tolist()):
            assert named.setdefault(raw[a:b].tobytes(), h) == h
        assert len(set(named.values())) == len(named)
    for width in (1, 2, 3, 8, 35):
        want = spans_hash(values, np.arange(3001 - width), np.arange(3001 - width) + width)
        assert (windows_hash(values, width) == want).all()
    assert len(windows_hash(values[:3], 4)) == 0


@pytest.mark.parametrize("size", [1024, 8192])
def test_operators_tell_the_words_apart(spark, size):
    a, b = thue_morse(size)
    common = " ".join(f"w{i}" for i in range(30)), " ".join(f"v{i}" for i in range(20))
    rows = [(1, a), (2, b), (3, f"{common[0]} {a} {common[1]}"), (4, f"{common[0]} {b} {common[1]}")]
    docs = documents(spark, rows)
    place, _ = components([t for _, t in rows], 4, 80)
    linked = {frozenset(i for (i, _), p in zip(rows, place) if p == own) for own in place}
    got = hyperminhash.near_groups(docs, width=4, percent=80).collect()
    assert {frozenset(r.id for r in got if r.component_id == c) for c in {r.component_id for r in got}} == linked
    cut = substrings.without_repeats(docs).collect()
    assert [r.n_removed for r in cut] == [0, 0, 0, 0]
    from tokenizers import Tokenizer

    path = tokenizer_path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    pieces = packing.pieces(docs, path, with_ids=True, capacity=1 << 16).collect()
    assert {r.id: list(r.ids) for r in pieces} == {i: [*tokenizer.encode(t, add_special_tokens=False).ids, 2] for i, t in rows}
    spelled = nbest.n_best(docs, tokenizer_path("piece_bpe_32k.model"), 1).select("id", "decoded_sha256")
    want = docs.select(F.col("doc_id").alias("id"), F.sha2("text", 256).alias("decoded_sha256"))
    assert sorted(spelled.collect()) == sorted(want.collect())
