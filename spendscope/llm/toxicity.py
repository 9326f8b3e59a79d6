"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features are the distinct words, pairs of adjacent words and pairs one word apart, hashed to
``FEATURE_BITS`` bits, and the first ``STEMS`` bytes of longer words, so that unseen endings of
a word count as well. FTRL-proximal learns with a rate per coordinate; its L1 penalty leaves
some hundred weights that are not 0. These are sent to all tasks, and every text is scored
where it lies, without a shuffle. Toxic texts are the fewer and weigh ``TOXIC_WEIGHT`` times as
much, so the score of 0.5 stands between the two kinds and not at the rarer one's edge.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendscope.llm.batches import ROWS, give_back, in_small_batches, tidy
from spendscope.llm.words import LOWER_ALNUM, U64, Words, as_long, bytes_hash, mix, split_words, windows_hash
from spendscope.session import stored

#: Labelled rows that the model is fitted on at most: those with the smallest hashed ids.
SAMPLE_ROWS = 8192
FEATURE_BITS = 48
STEMS = (4, 6, 8)
#: Places of the table in which the fit counts the texts of features, a byte each for clean and toxic ones.
SLOTS = 1 << 23
EPOCHS = 4
ALPHA, BETA, L1, L2 = 0.5, 1.0, 12.0, 1.0
TOXIC_WEIGHT = 3.0


def kinds(words: Words) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Features with repeats, and the text each is in, one kind after the other."""
    h = words.hash
    text = np.repeat(np.arange(len(words)), np.diff(words.first))
    shift = U64(64 - FEATURE_BITS)
    yield h >> shift, text
    for reach in (1, 2):
        at = np.flatnonzero(text[reach:] == text[:-reach])
        two = windows_hash(h, 2)[at] if reach == 1 else mix(h[at] * U64(3) + mix(h[at + 2]))
        yield two >> shift, text[at]
    folded = words.split.folded[words.raw]
    for n in STEMS:
        at = np.flatnonzero(words.end - words.start > n)
        stem = bytes_hash(folded, words.start[at], words.start[at] + n)
        yield mix(stem + U64(n)) >> shift, text[at]


def features(words: Words) -> Iterator[np.ndarray]:
    """The distinct features of each text."""
    found, text = map(np.concatenate, zip(*kinds(words)))
    order = np.lexsort((found, text))
    found, text = found[order], text[order]
    new = np.ones(len(found), bool)
    new[1:] = (found[1:] != found[:-1]) | (text[1:] != text[:-1])
    found, text = found[new], text[new]
    yield from np.split(found, np.searchsorted(text, np.arange(1, len(words)))) if len(words) else ()


def ftrl(rows: list[np.ndarray], labels: np.ndarray, size: int, epochs: int = EPOCHS) -> tuple[np.ndarray, float]:
    """Weights of ``size`` features, and the bias, after some rounds over the rows.

    A row lists the features it has. The bias is not penalised. A row of label 1 moves them
    ``TOXIC_WEIGHT`` times as much.
    """
    z, n = np.zeros(size + 1), np.zeros(size + 1)
    penalty = np.full(size + 1, L1)
    penalty[size] = 0

    def weight(at: np.ndarray) -> np.ndarray:
        own = z[at]
        rate = (BETA + np.sqrt(n[at])) / ALPHA + L2
        return np.where(np.abs(own) > penalty[at], -(own - np.sign(own) * penalty[at]) / rate, 0.0)

    rows = [np.append(r, np.array(size, r.dtype)) for r in rows]
    for turn in range(epochs):
        for i in np.random.default_rng(turn).permutation(len(rows)):
            at = rows[i]
            w = weight(at)
            slope = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35))) - labels[i]
            slope *= TOXIC_WEIGHT if labels[i] else 1
            root = np.sqrt(n[at])
            n[at] += slope * slope
            z[at] += slope - (np.sqrt(n[at]) - root) / ALPHA * w
    w = weight(np.arange(size + 1))
    return w[:size], float(w[size])


def reachable(rows: list[np.ndarray], labels: np.ndarray, size: int) -> np.ndarray:
    """Which features can get a weight at all.

    Until a feature has one, its slopes add up, each at most 1, or ``TOXIC_WEIGHT`` with label 1.
    A sum that cannot exceed L1 keeps the weight at 0, so leaving such features out changes nothing.
    """
    most = np.zeros((2, size))
    for own, label in zip(rows, labels):
        most[int(label), own] += EPOCHS * (TOXIC_WEIGHT if label else 1)
    return most.max(axis=0) > L1


def _slot(found: np.ndarray) -> np.ndarray:
    return (found & U64(SLOTS - 1)).astype(np.int64)


def candidates(rows: list[np.ndarray], labels: np.ndarray) -> np.ndarray:
    """For each slot, whether any of its features may be ``reachable``.

    Counts the texts with a feature in the slot, up to 255: as many as hold any one of them, or more.
    """
    texts = np.zeros((2, SLOTS), np.uint8)
    for own, label in zip(rows, labels):
        count, at = texts[int(label)], _slot(own)
        count[at] = np.minimum(count[at], 254) + 1
    enough = [np.argmax(np.append(np.arange(255) * (EPOCHS * weight) > L1, True)) for weight in (1, TOXIC_WEIGHT)]
    return (texts[0] >= enough[0]) | (texts[1] >= enough[1])


def coded(rows: list[np.ndarray], labels: np.ndarray) -> np.ndarray:
    """Replaces the features in ``rows`` by their places in the list of reachable ones, which is returned.

    Most features stand in too few texts to count. They go before the others are sorted, some
    rows at a time, so no more than the rows themselves is held.
    """
    kept = candidates(rows, labels)
    for i, own in enumerate(rows):
        rows[i] = own[kept[_slot(own)]]
    distinct = np.zeros(0, U64)
    for low in range(0, len(rows), ROWS):
        some = np.sort(np.concatenate([distinct, *rows[low : low + ROWS]]))
        distinct = some[np.append(True, some[1:] != some[:-1])] if len(some) else some
    for i, own in enumerate(rows):
        rows[i] = np.searchsorted(distinct, own).astype(np.int32)
    used = reachable(rows, labels, len(distinct))
    place = (np.cumsum(used) - 1).astype(np.int32)
    for i, own in enumerate(rows):
        rows[i] = place[own[used[own]]]
    return distinct[used]


def _fit(sample: pa.Table) -> pa.Table:
    # The rows' order must not depend on how they arrived.
    order = pc.sort_indices(sample["id"])
    texts, labels = sample["body"].cast(pa.large_string()).take(order), sample["toxic"].take(order).to_numpy().astype(float)
    del sample
    rows = [f for words in split_words(texts, LOWER_ALNUM) for f in features(words)]
    del texts
    used = coded(rows, labels)
    weights, bias = ftrl(rows, labels, len(used))
    kept = np.flatnonzero(weights)
    found = pa.table({"feature": np.append(as_long(used[kept]), -1), "weight": np.append(weights[kept], bias)})
    del rows, used
    give_back()
    return found


def fit(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The weights (feature, weight) learnt from ``labels`` (id, toxic); feature -1 is the bias.

    Rows without an id or label teach nothing; of several labels for one id the largest counts.
    At most ``sample_rows`` ids are taken. They are few enough to be broadcast, so the texts of
    the others are not shuffled. Without any labelled text there are no weights.
    """
    chosen = (
        labels.select(F.col(id).alias("label_id"), F.col("toxic").cast("int").alias("toxic"))
        .dropna()
        .groupBy("label_id")
        .agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("label_id"), "label_id")
        .limit(sample_rows)
    )
    texts = docs.select(F.col(id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("body"))
    sample = texts.join(F.broadcast(chosen), F.col("id") == F.col("label_id"))
    # An id that is repeated teaches one text, the greatest.
    sample = sample.groupBy("id").agg(F.max("body").alias("body"), F.first("toxic").alias("toxic"))
    return sample.groupBy(F.lit(0).alias("all")).applyInArrow(_fit, "feature long, weight double")


def _scorer(feature: np.ndarray, weight: np.ndarray, bias: float):
    feature = feature.astype(U64)
    # Most features have no weight: one look at a small table tells.
    slots = np.zeros(1 << 20, bool)
    slots[(feature & U64((1 << 20) - 1)).astype(np.int64)] = True

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for words in split_words(batch.column("body"), LOWER_ALNUM):
                found, whose = [], []
                for f, text in kinds(words):
                    at = np.flatnonzero(slots[(f & U64((1 << 20) - 1)).astype(np.int64)])
                    found.append(f[at])
                    whose.append(text[at])
                f, text = np.concatenate(found), np.concatenate(whose)
                at = np.searchsorted(feature, f)
                at[at == len(feature)] = 0
                hit = feature[at] == f if len(feature) else np.zeros(len(f), bool)
                once = np.unique(text[hit] * (len(feature) + 1) + at[hit])
                text, at = once // (len(feature) + 1), once % (len(feature) + 1)
                total = np.bincount(text, weight[at], len(words)) if len(once) else np.zeros(len(words))
                value = 1 / (1 + np.exp(-np.clip(total + bias, -35, 35)))
                yield pa.RecordBatch.from_arrays([batch.column("doc").slice(words.row, len(words)), pa.array(value)], ["doc", "score"])

    return score


def scored(docs: DataFrame, weights: DataFrame, doc: Column, text: str = "text") -> DataFrame:
    """Rows (doc, score): the probability that a text is toxic; NULL counts as empty.

    Collects ``weights``, some hundred rows: each was earned in several texts of the sample.
    """
    rows = weights.orderBy("feature").toPandas()
    bias = rows.loc[rows["feature"] == -1, "weight"].sum() if len(rows) else -35.0
    rows = rows[rows["feature"] >= 0]
    score = _scorer(rows["feature"].to_numpy(np.int64), rows["weight"].to_numpy(float), float(bias))
    out = in_small_batches(docs).select(doc.alias("doc"), F.coalesce(F.col(text), F.lit("")).alias("body"))
    return out.mapInArrow(tidy(score), T.StructType([out.schema["doc"]]).add("score", "double"))


def toxicity(
    docs: DataFrame, labels: DataFrame, doc: Column, id: str = "doc_id", text: str = "text", sample_rows: int = SAMPLE_ROWS
) -> DataFrame:
    """Fits on ``labels`` and scores all ``docs``; the weights are written to a scratch table."""
    return scored(docs, stored(fit(docs, labels, id, text, sample_rows), "weights"), doc, text)


def fold(id: Column) -> Column:
    """crc32 of the id as text modulo 5; rows with 0 are held out."""
    return F.crc32(id.cast("string").cast("binary")) % 5
