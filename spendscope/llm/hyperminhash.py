"""Near-duplicates by HyperMinHash registers, banding and exact verification.

1. A text's words make a set of shingles. Its hashes fall into ``REGISTERS`` buckets by their
   top bits; a bucket keeps of its smallest hash the number of leading zeros and the next
   ``MANTISSA`` bits, 16 bits in all. Texts with the same words are one node from here on.
2. Registers are cut into bands of ``ROWS``. Nodes that agree in a whole band are candidates.
   An empty register borrows from another bucket, in an order that is fixed per register, so
   short texts are found as surely as long ones.
3. In each band bucket all nodes are first paired with the smallest one only, so a bucket's
   pairs grow with its nodes, not with their square. Pairs whose estimated similarity, corrected
   for registers that agree by chance, lies far below the threshold go. The others are verified
   on the full shingle sets.
4. Components of the verified links are found. Only in buckets that still hold several
   components are pairs between components looked at, in square blocks of bounded size. A
   block compares registers first, and each pair in the first band it shares only. Shingle
   sets of the nodes that are left follow, and the exact sizes of all intersections in the block
   come from matrix products, so pages that share a template without being linked cost no more
   than others. A block returns fewer links than it has nodes.

A pair at the threshold of 0.8 agrees in no band with a probability of 5e-8, and falls short of
the estimate (five standard deviations below) with one of 3e-7.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendscope.llm.batches import in_small_batches, tidy
from spendscope.llm.graph import components
from spendscope.llm.groups import sorted_groups
from spendscope.llm.members import bitmap, marked
from spendscope.llm.words import LOWER, U64, Words, as_long, mix, spans_hash, split_words, windows_hash
from spendscope.operators.joins import attach
from spendscope.session import stored

REGISTERS = 256
MANTISSA = 10
#: Bands of the first registers; all of them make the estimate.
ROWS, BANDS = 4, 32
#: Nodes of a band bucket that one task compares with as many others at once, and their shingles.
SQUARE, SQUARE_SHINGLES = 4096, 1 << 22
#: Holders of an item up to which their pairs are counted one by one; items and pairs handled at once.
FEW, ITEMS_AT_ONCE, PAIRS_AT_ONCE = 32, 512, 1 << 22
_VALUE_BITS = 56  # of a 64-bit hash, 8 name the bucket
#: For each register the order in which it looks for a bucket to borrow from.
_BORROW = np.argsort(mix(np.arange(REGISTERS * REGISTERS, dtype=U64) + U64(1)).reshape(REGISTERS, REGISTERS), axis=1)


def shingles(words: Words, width: int) -> Iterator[np.ndarray]:
    """The sorted shingle hashes of each text; fewer words than ``width`` make one shingle."""
    hashes = windows_hash(words.hash, width)
    short = np.diff(words.first) < width
    whole = spans_hash(words.hash, words.first[:-1], words.first[1:])
    for i, (_, first, end) in enumerate(words.bounds()):
        if first == end:
            yield hashes[:0]
        else:
            yield whole[i : i + 1] if short[i] else np.unique(hashes[first : end - width + 1])


def registers(smallest: np.ndarray) -> np.ndarray:
    """Registers of bucket minima: leading zeros and mantissa; 0 stays 0 for an empty bucket.

    ``smallest`` holds a minimum's ``_VALUE_BITS`` bits plus one.
    """
    fraction, bits = np.frexp(smallest.astype(np.float64))
    zeros = np.maximum(_VALUE_BITS + 1 - bits, 0)
    mantissa = ((fraction * 2 - 1) * (1 << MANTISSA)).astype(np.int64)
    return np.where(smallest > 0, (zeros << MANTISSA) + mantissa + 1, 0).astype(np.uint16)


def minima(hashes: np.ndarray) -> np.ndarray:
    """The smallest value in each bucket of sorted hashes, plus one; 0 where there is none."""
    low = np.arange(REGISTERS, dtype=U64) << U64(_VALUE_BITS)
    at = np.append(np.searchsorted(hashes, low), len(hashes))
    found = np.zeros(REGISTERS, U64)
    full = at[1:] > at[:-1]
    found[full] = (hashes[at[:-1][full]] & U64((1 << _VALUE_BITS) - 1)) + U64(1)
    return found


def band_keys(regs: np.ndarray) -> np.ndarray:
    """One key per band for each row of registers."""
    source = np.where(regs > 0, regs.astype(U64) * U64(REGISTERS) + np.arange(REGISTERS, dtype=U64), U64(0))
    filled = source[:, : ROWS * BANDS].copy()
    some = (regs > 0).any(axis=1)
    for turn in range(REGISTERS):
        row, col = np.nonzero((filled == 0) & some[:, None])
        if not len(row):
            break
        filled[row, col] = source[row, _BORROW[col, turn]]
    key = np.broadcast_to(np.arange(BANDS, dtype=U64), (len(regs), BANDS))
    for place in range(ROWS):
        key = mix(key * U64(0x9E3779B97F4A7C15) + filled[:, place::ROWS])
    return as_long(np.ascontiguousarray(key))


def similarity(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Estimated Jaccard similarity of rows of registers, and the number of registers used.

    Two unequal minima agree with the probability that they fall into one cell. With rates x
    and y of elements per bucket, and cells on average 0.72 * 2**-MANTISSA times as wide as
    their distance from 0, that is 0.72 * 2**-MANTISSA * xy / (x + y)**2.
    """
    used = ((a > 0) | (b > 0)).sum(axis=-1)
    same = ((a == b) & (a > 0)).sum(axis=-1)
    x, y = n_a.astype(float), n_b.astype(float)
    chance = 0.7213 * 2.0**-MANTISSA * x * y / np.maximum(x + y, 1) ** 2
    return (same - used * chance) / np.maximum(used * (1 - chance), 1e-9), used


def likely(a, b, n_a, n_b, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs whose sizes and estimate allow the threshold, and the estimates."""
    estimate, used = similarity(a, b, n_a, n_b)
    margin = 5 * np.sqrt(threshold * (1 - threshold) / np.maximum(used, 1))
    fits = np.minimum(n_a, n_b) >= threshold * np.maximum(n_a, n_b) - 1e-9
    return fits & (estimate >= threshold - margin), estimate


_SKETCH = "number long, id long, source binary, n_shingles long, words binary, regs binary"


def _sketcher(width: int):
    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for words in split_words(batch.column("body"), LOWER):
                sets = list(shingles(words, width))
                least = np.stack([minima(s) for s in sets])
                regs = registers(least)
                raw = words.hash.tobytes()
                same = [xxhash.xxh3_128_digest(raw[8 * a : 8 * b]) for _, a, b in words.bounds()]
                part = batch.slice(words.row, len(words))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("number"),
                        part.column("id"),
                        part.column("source"),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array(same, pa.binary()),
                        pa.array([r.tobytes() for r in regs], pa.binary()),
                    ],
                    ["number", "id", "source", "n_shingles", "words", "regs"],
                )

    return sketch


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, REGISTERS)


def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            keys = band_keys(_matrix(batch.column("regs")))
            node, n = (np.repeat(batch.column(c).to_numpy(), BANDS) for c in ("node", "n_shingles"))
            yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), pa.array(node), pa.array(n)], ["band", "node", "n"])


def _estimator(threshold: float):
    def estimate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                regs = [_matrix(batch.column(c)) for c in ("regs_a", "regs_b")]
                sizes = [batch.column(c).to_numpy() for c in ("n_a", "n_b")]
                yield batch.select(["a", "b"]).filter(pa.array(likely(*regs, *sizes, threshold)[0]))

    return estimate


class _Block:
    """The nodes of a square block, and the pairs in it that may be linked."""

    def __init__(self, group: pa.Table, threshold: float):
        names = ("node", "component", "n_shingles", "part")
        self.node, self.component, self.n, self.part = (group.column(c).to_numpy() for c in names)
        self.band, self.left, self.right = (group.column(c)[0].as_py() for c in ("band", "left", "right"))
        self.regs, self.threshold = _matrix(group.column("regs")), threshold
        keys = band_keys(self.regs)
        self.keys = keys[:, : int(np.flatnonzero(keys[0] == self.band)[0])]

    def pairs(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For each node the others that it may be linked with, and the estimates.

        Pairs within a component, and pairs that share an earlier band, are left out.
        """
        rows, cols = np.flatnonzero(self.part == self.left), np.flatnonzero(self.part == self.right)
        for i in rows:
            other = cols[self.component[cols] != self.component[i]]
            if self.left == self.right:
                other = other[self.node[other] > self.node[i]]
            if not len(other):
                continue
            size = np.full(len(other), self.n[i])
            passed, estimate = likely(self.regs[[i]], self.regs[other], size, self.n[other], self.threshold)
            other, estimate = other[passed], estimate[passed]
            new = ~(self.keys[other] == self.keys[i]).any(axis=1)
            if new.any():
                yield i, other[new], estimate[new]


_KEY = ["band", "left", "right"]


def _finder(threshold: float):
    """The nodes of each block that may be linked with one of another component."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in sorted_groups(batches, _KEY):
            block = _Block(group, threshold)
            wanted = np.zeros(len(block.node), bool)
            for i, other, _ in block.pairs():
                wanted[i] = True
                wanted[other] = True
            if wanted.any():
                yield from group.filter(pa.array(wanted)).to_batches()

    return find


def overlaps(at: np.ndarray, values: np.ndarray, rows: np.ndarray, cols: np.ndarray) -> np.ndarray:
    """How many items each of the sets ``rows`` shares with each of ``cols``; set i is ``values[at[i]:at[i + 1]]``.

    Of a set with itself only the items that others have, too, are counted.
    Items of many sets are counted by matrix products, some at a time, those of few sets by the pairs of
    their holders. The work is set by the number of sets and items, not by the pairs that are alike.
    """
    total = np.zeros((len(rows), len(cols)), np.float32)
    _, code, count = np.unique(values, return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(at) - 1), np.diff(at))
    places = [np.full(len(at) - 1, -1) for _ in range(2)]
    for place, own in zip(places, (rows, cols)):
        place[own] = np.arange(len(own))
    order = np.argsort(code, kind="stable")
    owner, start = owner[order], np.concatenate([[0], np.cumsum(count)])
    frequent = np.flatnonzero(count > FEW)
    for low in range(0, len(frequent), ITEMS_AT_ONCE):
        some = frequent[low : low + ITEMS_AT_ONCE]
        holder = np.concatenate([owner[start[x] : start[x + 1]] for x in some])
        item = np.repeat(np.arange(len(some)), count[some])
        sides = []
        for place, own in zip(places, (rows, cols)):
            side = np.zeros((len(own), len(some)), np.float32)
            inside = place[holder] >= 0
            side[place[holder[inside]], item[inside]] = 1
            sides.append(side)
        total += sides[0] @ sides[1].T
    for n in range(2, FEW + 1):
        same = np.flatnonzero(count == n)
        step = max(1, PAIRS_AT_ONCE // (n * n))
        for low in range(0, len(same), step):
            holders = owner[start[same[low : low + step]][:, None] + np.arange(n)]
            a, b = np.broadcast_arrays(places[0][holders][:, :, None], places[1][holders][:, None, :])
            inside = (a >= 0) & (b >= 0)
            np.add.at(total, (a[inside], b[inside]), 1)
    return total


def _linker(percent: int):
    """Verified links between components, enough to connect what is connected in a block."""

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in sorted_groups(batches, _KEY):
            node, component, n, part = (group.column(c).to_numpy() for c in ("node", "component", "n_shingles", "part"))
            left, right = (group.column(c)[0].as_py() for c in ("left", "right"))
            items = group.column("items").combine_chunks()
            rows, cols = np.flatnonzero(part == left), np.flatnonzero(part == right)
            both = overlaps(items.offsets.to_numpy(), items.values.to_numpy(), rows, cols)
            _, label = np.unique(component, return_inverse=True)
            links = []
            for i, shared in zip(rows, both.astype(np.int64)):
                linked = cols[100 * shared >= percent * (n[i] + n[cols] - shared)]
                others, first = np.unique(label[linked], return_index=True)
                for other, j in zip(others, linked[first]):
                    if other != label[i]:
                        links.append((node[i], node[j]))
                        label[label == other] = label[i]
            if links:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*links)], ["a", "b"])

    return link


def _shingler(width: int):
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for words in split_words(batch.column("body"), LOWER):
                sets = [as_long(s) for s in shingles(words, width)]
                at = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
                values = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(np.concatenate(sets)))
                node = batch.column("node").slice(words.row, len(words))
                yield pa.RecordBatch.from_arrays([node, values], ["node", "items"])

    return make


def _rows(docs: DataFrame, id: str, text: str) -> DataFrame:
    body = F.coalesce(F.col(text), F.lit(""))
    source = F.substring(F.unhex(F.sha2(body, 256)), 1, 16)
    return in_small_batches(docs).select(
        F.monotonically_increasing_id().alias("number"), F.col(id).cast("long").alias("id"), source.alias("source"), body.alias("body")
    )


def near_groups(
    docs: DataFrame, id: str = "doc_id", text: str = "text", width: int = 5, percent: int = 80, square: int = SQUARE
) -> DataFrame:
    """One row per row of ``docs`` with the group of texts that it is linked with.

    Two texts are linked if ``100 * intersection >= percent * union`` holds for their sets of
    ``width``-word shingles (ASCII letters in lower case); groups are connected components.
    Columns: ``number`` and ``source`` (row and text, for joining back), ``id``, ``n_shingles``,
    ``component_id`` (the smallest id of the group) and ``first`` (True for one row of each
    group: one with that id). A text without words is a group of its own. NULL ids come last.
    Runs jobs and writes scratch tables.
    """
    threshold = percent / 100
    rows = stored(_rows(docs, id, text).mapInArrow(tidy(_sketcher(width)), _SKETCH), "sketches")
    worded = rows.where("n_shingles > 0")
    # Any row of a node may stand for it: the words are the same. min() needs fixed-size buffers.
    nodes = stored(
        worded.groupBy("words").agg(
            F.min("number").alias("node"), F.first("n_shingles").alias("n_shingles"), F.first("regs").alias("regs")
        ),
        "nodes",
    )
    bands = nodes.select("node", "n_shingles", "regs").mapInArrow(tidy(_bands), "band long, node long, n long")
    crowds = bands.groupBy("band").agg(
        F.min("node").alias("pivot"), F.count(F.lit(1)).alias("crowd"), F.sum("n").alias("weight")
    )
    # Tables of their own leave joins free to split the rows of a large key.
    crowds = stored(crowds.where("crowd > 1"), "crowds")
    seats = stored(bands.join(crowds, "band"), "seats")
    pairs = seats.where("node <> pivot").select(F.col("pivot").alias("a"), F.col("node").alias("b")).distinct()
    pairs = stored(_estimated(pairs, nodes, threshold), "pairs")
    ends = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    links = stored(_verified(pairs, _items(ends, docs, rows, id, text, width), percent), "links")
    found = stored(components(links), "components")

    # Buckets whose nodes are not all connected yet.
    placed = seats.where("crowd > 2").join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    torn = placed.groupBy("band").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high")
    parts = F.greatest(F.ceil(F.col("crowd") / square), F.ceil(F.col("weight") / SQUARE_SHINGLES)).cast("int")
    open_seats = (
        placed.join(stored(torn.select("band"), "torn"), "band", "left_semi")
        .withColumn("parts", parts)
        .withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .select("band", F.least("part", "other").alias("left"), F.greatest("part", "other").alias("right"), "part", "node", "component")
        .join(nodes.select("node", "n_shingles", "regs"), "node")
        .select(*_KEY, "part", "node", "component", "n_shingles", "regs")
    )
    blocks = open_seats.repartition(*_KEY).sortWithinPartitions(*_KEY)
    doubtful = stored(blocks.mapInArrow(tidy(_finder(threshold)), open_seats.schema), "doubtful")
    if not doubtful.isEmpty():
        items = _items(doubtful.select("node").distinct(), docs, rows, id, text, width)
        blocks = doubtful.join(items, "node").repartition(*_KEY).sortWithinPartitions(*_KEY)
        more = stored(blocks.mapInArrow(tidy(_linker(percent)), "a long, b long"), "links")
        if not more.isEmpty():
            found = stored(components(links.union(more)), "components")

    members = worded.select("words", "number", "id").join(nodes.select("words", "node"), "words")
    members = members.join(found, "node", "left").select("number", "id", F.coalesce("component", "node").alias("component"))
    heads = members.groupBy("component").agg(
        F.min("id").alias("component_id"), F.min_by("number", F.coalesce("id", F.lit((1 << 63) - 1))).alias("head"), F.count(F.lit(1)).alias("group_size")
    )
    grouped = members.join(stored(heads, "heads"), "component").select("number", "component_id", "head", "group_size")
    return rows.join(grouped, "number", "left").select(
        "number",
        "id",
        "source",
        "n_shingles",
        F.when(F.col("head").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id"),
        F.coalesce(F.col("head") == F.col("number"), F.lit(True)).alias("first"),
        F.coalesce("group_size", F.lit(1)).alias("group_size"),
    )


def _estimated(pairs: DataFrame, nodes: DataFrame, threshold: float) -> DataFrame:
    for side in "ab":
        sketch = nodes.select(F.col("node").alias(side), F.col("n_shingles").alias(f"n_{side}"), F.col("regs").alias(f"regs_{side}"))
        pairs = pairs.join(sketch, side)
    return pairs.mapInArrow(tidy(_estimator(threshold)), "a long, b long")


def _items(nodes: DataFrame, docs: DataFrame, rows: DataFrame, id: str, text: str, width: int) -> DataFrame:
    """The shingle sets of ``nodes`` as a scratch table (node, items).

    Their texts come from a second scan; no other text is shuffled.
    """
    wanted = stored(nodes.join(rows.select(F.col("number").alias("node"), "id", "source"), "node"), "wanted")
    bits = stored(bitmap(wanted, F.col("source")), "wanted_bits")
    texts = marked(_rows(docs, id, text).drop("number"), F.col("source"), bits, "wanted").where("wanted")
    chosen = attach(texts, wanted, ["id", "source"], "inner")
    # Repeated rows with one id give the same set again.
    chosen = chosen.dropDuplicates(["node"]).select("node", "body")
    return stored(chosen.mapInArrow(tidy(_shingler(width)), "node long, items array<long>"), "shingles")


def _verified(pairs: DataFrame, items: DataFrame, percent: int) -> DataFrame:
    """The pairs that are linked, by their full shingle sets."""
    for side in "ab":
        pairs = pairs.join(items.select(F.col("node").alias(side), F.col("items").alias(f"items_{side}")), side)
    both = F.size(F.array_intersect("items_a", "items_b")).cast("long")
    either = F.size("items_a") + F.size("items_b") - both
    return pairs.where(100 * both >= percent * either).select("a", "b")


def near_dedup(docs: DataFrame, id: str = "doc_id", text: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` that stay: one of each group of linked texts, and all texts without words.

    The one with the smallest id stays; of repeated rows with that id and text any one does.
    Rows that go are found by id and text; other rows are not shuffled.
    """
    groups = near_groups(docs, id, text, width, percent)
    # Texts without words all stay, repeated or not.
    worded = groups.where("n_shingles > 0").groupBy("id", "source")
    verdict = worded.agg(F.max("first").alias("stays"), F.count(F.lit(1)).alias("copies"))
    verdict = stored(verdict.where("not stays or copies > 1"), "verdict")
    bits = stored(bitmap(verdict, F.col("source")), "verdict_bits")
    source = F.substring(F.unhex(F.sha2(F.coalesce(F.col(text), F.lit("")), 256)), 1, 16)
    rows = docs.select(F.struct("*").alias("doc"), F.col(id).cast("long").alias("id"), source.alias("source"))
    rows = marked(rows, F.col("source"), bits, "member")
    judged = attach(rows.where("member"), verdict.select("id", "source", "stays"), ["id", "source"])
    once = judged.where("stays").groupBy("id", "source").agg(F.first("doc").alias("doc"))
    kept = (rows.where("not member"), judged.where("stays is null"), once)
    return kept[0].select("doc.*").union(kept[1].select("doc.*")).union(kept[2].select("doc.*"))
