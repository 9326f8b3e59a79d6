"""Removing repeated passages with suffix automata of reference shards.

A passage is a run of words that is covered by windows of ``width`` words which start anywhere
else as well. The whole corpus is its own reference, so neither it nor its automaton can be
broadcast: it grows with the data. Instead the reference is cut into shards by content, and
each shard's automaton meets only the pieces of text that can match it:

1. The smallest hash among a window's runs of ``ANCHOR`` words is the window's anchor. Equal
   windows have equal anchors, so the anchor names the window's shard. Adjacent windows with
   one anchor make a piece; there is one piece for every 15 words or so.
2. Pieces are counted by shard and content. A shard with one piece is done, nothing repeats.
   If all pieces of a shard are equal, all their windows are repeated.
3. For each other shard the words of its distinct pieces are fetched. A suffix automaton of
   them is built, with the number of occurrences of each state, and the pieces are streamed
   through it for matching statistics: the longest run up to each word that occurs at least
   twice. Runs of ``width`` words or more are removed.
4. A shard of very many distinct pieces would be too much for one task. Its windows are
   counted by their hashes instead, summed up on the map side.

Pieces of one text with one anchor cannot hold equal windows, as the leftmost smallest run
stands at the same place in both; so counting pieces by content counts windows, too.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendscope.llm.batches import in_small_batches, tidy
from spendscope.llm.groups import sorted_groups
from spendscope.llm.members import bitmap, marked
from spendscope.llm.words import PLAIN, U64, Words, as_long, spans_hash, split_words, windows_hash
from spendscope.operators.joins import attach
from spendscope.session import stored

WIDTH = 35
ANCHOR = 8
#: Distinct pieces of a shard up to which it gets an automaton.
SHARD_PIECES = 512


def anchors(hashes: np.ndarray, width: int, run: int) -> np.ndarray:
    """For each window of ``width`` values the place of its anchor, the leftmost smallest run.

    ``hashes`` are those of the runs. Minima of 2, 4, 8 … places are combined.
    """
    size = width - run + 1
    best = np.arange(len(hashes))
    done = 1
    while done < size:
        step = min(done, size - done)
        left, right = best[: len(best) - step], best[step:]
        best = np.where(hashes[left] <= hashes[right], left, right)
        done += step
    return best


def _pieces(words: Words, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text, first window, number of windows, anchor and content hash of each piece."""
    run = min(ANCHOR, width)
    if len(words.hash) < width:
        empty = np.zeros(0, np.int64)
        return empty, empty, empty, empty, empty
    runs = windows_hash(words.hash, run)
    place = anchors(runs, width, run)
    starts = np.arange(len(place))
    of = np.searchsorted(words.first, starts, "right") - 1
    starts = np.flatnonzero(starts + width <= words.first[of + 1])
    of, place = of[starts], place[starts]
    new = np.ones(len(starts), bool)
    new[1:] = (place[1:] != place[:-1]) | (of[1:] != of[:-1]) | (starts[1:] != starts[:-1] + 1)
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(starts)))
    at = starts[first]
    content = spans_hash(words.hash, at, at + count + width - 1)
    return of[first], at - words.first[of[first]], count, as_long(runs[place[first]]), as_long(content)


_PIECE = "id long, source long, source2 long, at int, n int, shard long, piece long"


def _piece_maker(width: int):
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for words in split_words(batch.column("body"), PLAIN):
                of, at, n, shard, piece = _pieces(words, width)
                rows = pa.array(of + words.row)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id").take(rows),
                        batch.column("source").take(rows),
                        batch.column("source2").take(rows),
                        pa.array(at, pa.int32()),
                        pa.array(n, pa.int32()),
                        pa.array(shard, pa.int64()),
                        pa.array(piece, pa.int64()),
                    ],
                    ["id", "source", "source2", "at", "n", "shard", "piece"],
                )

    return make


def _fetcher(width: int):
    """The word hashes of the pieces that are wanted from a text."""

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wanted = batch.column("wanted")
            for words in split_words(batch.column("body"), PLAIN):
                rows = []
                for row, first, _ in words.bounds():
                    for w in wanted[row].as_py():
                        at = first + w["at"]
                        rows.append((w["shard"], w["piece"], w["copies"], w["pieces"], words.hash[at : at + w["n"] + width - 1]))
                if rows:
                    columns = [pa.array([r[i] for r in rows], pa.int64()) for i in range(4)]
                    data = pa.array([r[4].tobytes() for r in rows], pa.binary())
                    yield pa.RecordBatch.from_arrays([*columns, data], ["shard", "piece", "copies", "pieces", "words"])

    return fetch


class Automaton:
    """A suffix automaton of several word sequences that counts their occurrences."""

    def __init__(self) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.length = [0]
        self.count = [0]

    def _state(self, length: int, copy: int | None = None) -> int:
        self.next.append({} if copy is None else dict(self.next[copy]))
        self.link.append(-1 if copy is None else self.link[copy])
        self.length.append(length)
        self.count.append(0)
        return len(self.link) - 1

    def _clone(self, state: int, word: int, target: int) -> int:
        new = self._state(self.length[state] + 1, target)
        self.link[target] = new
        while state >= 0 and self.next[state].get(word) == target:
            self.next[state][word] = new
            state = self.link[state]
        return new

    def add(self, words: list[int], weight: int) -> None:
        last = 0
        for word in words:
            target = self.next[last].get(word)
            if target is not None:
                if self.length[target] != self.length[last] + 1:
                    target = self._clone(last, word, target)
                last = target
            else:
                new, state = self._state(self.length[last] + 1), last
                while state >= 0 and word not in self.next[state]:
                    self.next[state][word] = new
                    state = self.link[state]
                if state < 0:
                    self.link[new] = 0
                else:
                    target = self.next[state][word]
                    if self.length[target] != self.length[state] + 1:
                        target = self._clone(state, word, target)
                    self.link[new] = target
                last = new
            self.count[last] += weight

    def sum_up(self) -> None:
        """Gives each state the occurrences of all states that end with its words."""
        for state in sorted(range(1, len(self.link)), key=self.length.__getitem__, reverse=True):
            if self.link[state] > 0:
                self.count[self.link[state]] += self.count[state]

    def repeated(self, words: list[int]) -> list[int]:
        """For each word the length of the longest run up to it that occurs at least twice."""
        state, length, out = 0, 0, []
        for word in words:
            while True:
                target = self.next[state].get(word)
                if target is not None and self.count[target] > 1:
                    # The state's longest run may be longer than the match so far.
                    state, length = target, length + 1
                    break
                if state == 0:
                    length = 0
                    break
                state = self.link[state]
                length = self.length[state]
            out.append(length)
        return out


def _ranges(hits: np.ndarray) -> list[tuple[int, int]]:
    edge = np.flatnonzero(np.diff(np.concatenate([[0], hits.astype(np.int8), [0]])))
    return list(zip(edge[::2].tolist(), edge[1::2].tolist()))


_FOUND = "shard long, piece long, low int, high int"


def _matcher(width: int):
    """Windows [low, high) of each piece that the shard's automaton finds repeated."""

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in sorted_groups(batches, ["shard"]):
            pieces, copies = (group.column(c).to_pylist() for c in ("piece", "copies"))
            texts = [np.frombuffer(w, U64).tolist() for w in group.column("words").to_pylist()]
            automaton = Automaton()
            for words, n in zip(texts, copies):
                automaton.add(words, n)
            automaton.sum_up()
            rows = []
            for piece, words in zip(pieces, texts):
                hits = np.array(automaton.repeated(words)[width - 1 :]) >= width
                rows += [(piece, low, high) for low, high in _ranges(hits)]
            if rows:
                piece, low, high = zip(*rows)
                shard = pa.array([group.column("shard")[0].as_py()] * len(rows), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [shard, pa.array(piece, pa.int64()), pa.array(low, pa.int32()), pa.array(high, pa.int32())],
                    ["shard", "piece", "low", "high"],
                )

    return match


def _window_maker(width: int):
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                words = np.frombuffer(batch.column("words")[i].as_py(), U64)
                hashes = as_long(windows_hash(words, width))
                fixed = [pa.array(np.full(len(hashes), batch.column(c)[i].as_py()), pa.int64()) for c in ("shard", "piece", "copies")]
                low = pa.array(np.arange(len(hashes)), pa.int32())
                yield pa.RecordBatch.from_arrays([*fixed, low, pa.array(hashes)], ["shard", "piece", "copies", "low", "window"])

    return make


SOURCE = ("source", "source2")


def _rows(docs: DataFrame, id: str, text: str, **more: Column) -> DataFrame:
    """Id, text and a 128-bit hash that names the text wherever it occurs."""
    body = F.coalesce(F.col(text), F.lit(""))
    return in_small_batches(docs).select(
        F.col(id).cast("long").alias("id"),
        F.xxhash64(body).alias("source"),
        F.xxhash64(F.lit(1), body).alias("source2"),
        body.alias("body"),
        *(c.alias(n) for n, c in more.items()),
    )


def repeated_spans(
    docs: DataFrame, id: str = "doc_id", text: str = "text", width: int = WIDTH, shard_pieces: int = SHARD_PIECES
) -> DataFrame:
    """The words to remove: rows (source, source2, spans), one for each text that
    has any. ``source`` and ``source2`` hash the text, ``spans`` an array of (low, high) word ranges, which
    may overlap. Texts with fewer words than ``width`` have none. Runs jobs and writes scratch
    tables; the largest holds about 40 bytes for every 15 words.
    """
    pieces = stored(_rows(docs, id, text).mapInArrow(tidy(_piece_maker(width)), _PIECE), "pieces")
    # The columns of first() come from one row, and the table is written once.
    where = [F.first(c).alias(c) for c in ("id", *SOURCE, "at", "n")]
    distinct = pieces.groupBy("shard", "piece").agg(F.count(F.lit(1)).alias("copies"), *where)
    distinct = stored(distinct, "distinct_pieces")
    shards = distinct.groupBy("shard").agg(F.sum("copies").alias("all"), F.count(F.lit(1)).alias("pieces")).where("all > 1")
    # Tables of their own leave joins free to split the rows of a large key.
    shards = stored(shards.select("shard", "pieces"), "shards")
    known = stored(distinct.join(shards, "shard"), "known")

    whole = known.where("copies > 1").select("shard", "piece", F.lit(0).alias("low"), F.col("n").alias("high"))
    mixed = known.where("pieces > 1")
    asked = mixed.groupBy("id", *SOURCE).agg(F.collect_list(F.struct("shard", "piece", "copies", "pieces", "at", "n")).alias("wanted"))
    asked = stored(asked, "asked")
    bits = stored(bitmap(asked, F.col("source")), "asked_bits")
    texts = marked(_rows(docs, id, text), F.col("source"), bits, "member").where("member")
    texts = attach(texts, asked, ["id", *SOURCE], "inner")
    fetched = texts.select("body", "wanted").mapInArrow(
        tidy(_fetcher(width)), "shard long, piece long, copies long, pieces long, words binary"
    )
    # Repeated rows with one id would give a piece twice.
    fetched = stored(fetched.dropDuplicates(["shard", "piece"]), "fetched")
    found = (
        fetched.where(F.col("pieces") <= shard_pieces)
        .repartition("shard")
        .sortWithinPartitions("shard")
        .mapInArrow(tidy(_matcher(width)), _FOUND)
    )
    # Dealt by piece, so that no task makes the windows of a whole shard.
    large = fetched.where(F.col("pieces") > shard_pieces).repartition("shard", "piece")
    windows = large.mapInArrow(tidy(_window_maker(width)), "shard long, piece long, copies long, low int, window long")
    often = windows.groupBy("shard", "window").agg(F.sum("copies").alias("n")).where("n > 1").select("shard", "window")
    counted = windows.join(stored(often, "often"), ["shard", "window"]).select("shard", "piece", "low", (F.col("low") + 1).alias("high"))

    repeated = whole.union(found).union(counted)
    low, high = F.col("at") + F.col("low"), F.col("at") + F.col("high") + (width - 1)
    spans = pieces.join(repeated, ["shard", "piece"]).select(*SOURCE, F.struct(low.alias("low"), high.alias("high")).alias("span"))
    return stored(spans.groupBy(*SOURCE).agg(F.collect_set("span").alias("spans")), "spans")


def kept_text(words: Words, gone: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all kept words, one space between those of a text, and where each text starts."""
    start, end = words.start[~gone], words.end[~gone]
    edge = np.zeros(len(words.raw) + 1, np.int8)
    edge[start] += 1
    edge[end] -= 1
    raw = words.raw.copy()
    mask = np.cumsum(edge[:-1]).astype(bool)
    kept = np.concatenate([[0], np.cumsum(~gone)])[words.first]
    heads = np.zeros(len(start) + 1, bool)
    heads[kept] = True
    gaps = start[~heads[:-1]] - 1  # the separator before a word that is not its text's first
    raw[gaps] = 32
    mask[gaps] = True
    return raw[mask], np.concatenate([[0], np.cumsum(mask)])[words.text]


def _cutter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        spans = batch.column("spans")
        lists = spans.offsets.to_numpy()
        low, high = (spans.values.field(i).to_numpy() for i in range(2))
        for words in split_words(batch.column("body"), PLAIN):
            gone = np.zeros(len(words.hash) + 1, np.int32)
            for row, first, _ in words.bounds():
                a, b = lists[row], lists[row + 1]
                if b > a:
                    np.add.at(gone, first + low[a:b], 1)
                    np.add.at(gone, first + high[a:b], -1)
            gone = np.cumsum(gone[:-1]) > 0
            data, at = kept_text(words, gone)
            text = pa.LargeStringArray.from_buffers(len(words), pa.py_buffer(at.astype(np.int64)), pa.py_buffer(data))
            removed = np.diff(np.concatenate([[0], np.cumsum(gone)])[words.first])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc").slice(words.row, len(words)),
                    pa.array(np.diff(words.first), pa.int64()),
                    pa.array(removed, pa.int64()),
                    text.cast(pa.string()),
                ],
                ["doc", "n_words", "n_removed", "kept_text"],
            )


def without_repeats(
    docs: DataFrame, id: str = "doc_id", text: str = "text", carry: tuple[str, ...] | None = None,
    width: int = WIDTH, shard_pieces: int = SHARD_PIECES,
) -> DataFrame:
    """Every row of ``docs`` with what is left of its text.

    Columns: ``doc`` (struct of the input columns, or of those in ``carry``), ``n_words``,
    ``n_removed``, ``kept_text`` (kept words with one space between them). NULL has no words.
    Texts without repeats are not shuffled.
    """
    spans = repeated_spans(docs, id, text, width, shard_pieces)
    bits = stored(bitmap(spans, F.col("source")), "span_bits")
    doc = F.struct(*(carry or ["*"]))
    rows = marked(_rows(docs, id, text, doc=doc), F.col("source"), bits, "member")
    none = F.expr("cast(array() as array<struct<low: int, high: int>>)")
    plain = rows.where("not member").select("doc", "body", none.alias("spans"))
    cut = rows.where("member").join(spans, list(SOURCE), "left").select("doc", "body", F.coalesce("spans", none).alias("spans"))
    schema = T.StructType([plain.schema["doc"]]).add("n_words", "long").add("n_removed", "long").add("kept_text", "string")
    return plain.mapInArrow(tidy(_cutter), schema).union(cut.mapInArrow(tidy(_cutter), schema))
