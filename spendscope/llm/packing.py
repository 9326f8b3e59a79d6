"""Packing token sequences: best-fit decreasing over a segment tree of open windows.

Texts are tokenized where they lie and cut: an overlong one into full windows and a rest. Only
the lengths of the pieces are shuffled, to shards of a bounded number of pieces. A shard is
sorted by falling length and streamed through one packer: a segment tree over the remaining
capacities 0 … capacity finds the tightest open window that takes a piece. Padding shrinks with
the pieces per shard and is far below a percent at the default.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendscope.llm.batches import in_small_batches, tidy
from spendscope.llm.words import LOWER, PLAIN, Words, bytes_hash, split_words
from spendscope.session import stored

CAPACITY = 4096
END_ID = 2
SHARD_PIECES = 1 << 17
#: Distinct words whose ids a task remembers, about 150 bytes each.
REMEMBERED = 1 << 18
#: Words given to the tokenizer together; its answers are a KB and more for each.
AT_ONCE = 1 << 10
SHARD_SEQUENCES = 1 << 40


#: Words of Latin letters, which stay as they are but for being made small.
_PLAIN = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+")


def _spelling() -> dict[int, str]:
    """How a byte-level vocabulary spells the letters of Latin-1: one printable character per byte."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    spelled = {b: chr(b) for b in shown} | {b: chr(256 + n) for n, b in enumerate(hidden)}
    return {c: "".join(spelled[b] for b in chr(c).encode()) for c in range(0xC0, 0x100)}


class WordEncoder:
    """Token ids of texts, word by word, for a tokenizer that drops white space.

    Its parts (normal form, lower case, split, merges) work on each run without white space on
    its own, so the ids of a text are those of its words in a row. A full stop or comma behind
    an ASCII letter or digit is a part of its own, too, which saves remembering both forms.
    Words of plain letters go straight to the merges.
    """

    def __init__(self, path: str):
        # Spark runs a worker for each core; more threads would only take memory.
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model, self.spelling = self.tokenizer.model, _spelling()
        self._forget()

    def _forget(self) -> None:
        self.known: dict[int, int] = {}
        # In parts, which are joined when there are many.
        self.ids, self.at = [np.zeros(0, np.int32)], [np.zeros(1, np.int64)]

    def _learn(self, hashes: np.ndarray, texts: list[str]) -> None:
        found: list[list[int]] = [[]] * len(texts)
        rest = []
        for i, t in enumerate(texts):
            if _PLAIN.fullmatch(t):
                spelled = t.lower() if t.isascii() else t.lower().translate(self.spelling)
                found[i] = [x.id for x in self.model.tokenize(spelled)]
            else:
                rest.append(i)
        for low in range(0, len(rest), AT_ONCE):
            some = rest[low : low + AT_ONCE]
            for i, coded in zip(some, self.tokenizer.encode_batch_fast([texts[i] for i in some], add_special_tokens=False)):
                found[i] = coded.ids
        self.known.update(zip(hashes.tolist(), range(len(self.known), len(self.known) + len(texts))))
        self.at.append(self.at[-1][-1] + np.cumsum([len(f) for f in found]))
        self.ids.append(np.fromiter(chain.from_iterable(found), np.int32))

    def encode(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, and where each text's ids start."""
        raw, start, end = words.raw, words.start, words.end
        last, before = raw[end - 1], raw[np.maximum(end - 2, 0)]
        # ASCII letters and digits: 48-57, 65-90, 97-122.
        plain = ((before >= 48) & (before < 58)) | (((before | 32) >= 97) & ((before | 32) < 123))
        cut = np.flatnonzero(((last == 46) | (last == 44)) & plain & (end - start > 1))
        first = words.first + np.searchsorted(cut, words.first)
        start = np.insert(start, cut + 1, end[cut] - 1)
        tail = end[cut]
        end = end.copy()
        end[cut] -= 1
        end = np.insert(end, cut + 1, tail)
        # The names of special tokens are found before letters are made small.
        named = b"<|" in raw.tobytes()
        hashes = bytes_hash((PLAIN if named else LOWER).folded[raw], start, end)
        distinct, code = np.unique(hashes, return_inverse=True)
        if len(self.known) + len(distinct) > REMEMBERED:
            self._forget()
        index = np.fromiter(map(self.known.get, distinct.tolist(), repeat(-1)), np.int64, len(distinct))
        new = np.flatnonzero(index < 0)
        if len(new):
            where = np.empty(len(distinct), np.int64)
            where[code[::-1]] = np.arange(len(code))[::-1]
            where = where[new]
            self._learn(distinct[new], [raw[a:b].tobytes().decode() for a, b in zip(start[where], end[where])])
            index[new] = len(self.known) - len(new) + np.arange(len(new))
            self.at, self.ids = [np.concatenate(self.at)], [np.concatenate(self.ids)]
        (known_at,), (known_ids,) = self.at, self.ids
        at, count = known_at[index][code], (known_at[index + 1] - known_at[index])[code]
        total = np.concatenate([[0], np.cumsum(count)])
        ids = known_ids[np.repeat(at - total[:-1], count) + np.arange(total[-1])] if len(code) else known_ids[:0]
        return ids, total[first]


def _piece_maker(path: str, capacity: int, end_id: int, with_ids: bool):
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = WordEncoder(path)
        for batch in batches:
            for words in split_words(batch.column("body"), PLAIN, 1 << 19):
                ids, at = encoder.encode(words)
                rows, starts, lengths, sums, totals, tokens = [], [], [], [], [], []
                for i in range(len(words)):
                    own = np.append(ids[at[i] : at[i + 1]], end_id).astype("<u4")
                    for low in range(0, len(own), capacity):
                        piece = own[low : low + capacity]
                        rows.append(words.row + i)
                        starts.append(low)
                        lengths.append(len(piece))
                        sums.append(zlib.crc32(piece))
                        totals.append(len(own))
                        if with_ids:
                            tokens.append(piece.astype(np.int32))
                columns = [pa.array(c, pa.int64()) for c in (starts, lengths, sums, totals)]
                names = ["start", "length", "ids_crc32", "doc_tokens"]
                if with_ids:
                    columns.append(pa.array(tokens, pa.list_(pa.int32())))
                    names.append("ids")
                take = pa.array(rows, pa.int64())
                own = [batch.column(c).take(take) for c in ("number", "id")]
                yield pa.RecordBatch.from_arrays([*own, *columns], ["number", "id", *names])

    return make


def pieces(
    docs: DataFrame, tokenizer: str, id: str = "doc_id", text: str = "text",
    capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False,
) -> DataFrame:
    """The texts' tokens in pieces of at most ``capacity``: all but a text's last are full.

    Columns: ``number`` (of the row), ``id``, ``start``, ``length``, ``ids_crc32``,
    ``doc_tokens`` and, if asked for, ``ids``. Each text ends with ``end_id``; NULL counts as
    empty. ``tokenizer`` is the path of a tokenizers file on all machines.
    """
    schema = "number long, id long, start long, length long, ids_crc32 long, doc_tokens long" + ", ids array<int>" * with_ids
    rows = in_small_batches(docs).select(
        F.monotonically_increasing_id().alias("number"),
        F.col(id).cast("long").alias("id"),
        F.coalesce(F.col(text), F.lit("")).alias("body"),
    )
    return rows.mapInArrow(tidy(_piece_maker(tokenizer, capacity, end_id, with_ids)), schema)


class OpenWindows:
    """Open windows in a segment tree indexed by remaining capacity.

    A leaf holds the windows with exactly that much room; an inner node tells how many there
    are below it.
    """

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.tree = [0] * (2 * self.leaves)
        self.windows: list[list[int]] = [[] for _ in range(capacity + 1)]

    def _count(self, room: int, change: int) -> None:
        node = room + self.leaves
        while node:
            self.tree[node] += change
            node >>= 1

    def put(self, room: int, window: int) -> None:
        if room:
            if not self.windows[room]:
                self._count(room, 1)
            self.windows[room].append(window)

    def take(self, need: int) -> tuple[int, int] | None:
        """The window with the least room that holds ``need``: (room, window)."""
        tree, node = self.tree, need + self.leaves
        while not tree[node]:
            while node & 1:  # up, past subtrees whose right side is done
                node >>= 1
            if not node:
                return None
            node += 1
        while node < self.leaves:
            node *= 2
            if not tree[node]:
                node += 1
        room = node - self.leaves
        window = self.windows[room].pop()
        if not self.windows[room]:
            self._count(room, -1)
        return room, window


def _packer(capacity: int):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, windows, opened = None, None, 0
        for batch in batches:
            sequences, offsets = [], []
            for own, length in zip(batch.column("shard").to_pylist(), batch.column("length").to_pylist()):
                if own != shard:
                    shard, windows, opened = own, OpenWindows(capacity), 0
                found = windows.take(length) if length < capacity else None
                if found is None:
                    found = (capacity, opened)
                    opened += 1
                room, window = found
                windows.put(room - length, window)
                sequences.append(shard * SHARD_SEQUENCES + window)
                offsets.append(capacity - room)
            rest = [n for n in batch.schema.names if n != "shard"]
            columns = [*(batch.column(n) for n in rest), pa.array(sequences, pa.int64()), pa.array(offsets, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, [*rest, "sequence_id", "offset"])

    return pack


def packed(pieces: DataFrame, capacity: int = CAPACITY, shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``: sequences of at most ``capacity``.

    Every piece lies in one sequence, the pieces of a sequence without gaps from offset 0.
    Pieces are spread evenly over shards by their number, whatever their ids or texts. Writes
    the pieces to a scratch table.
    """
    pieces = stored(pieces, "pieces")
    shards = max(1, -(-pieces.count() // shard_pieces))
    schema = pieces.schema.add("sequence_id", "long").add("offset", "long")
    return (
        pieces.withColumn("shard", F.pmod(F.xxhash64("number", "start"), F.lit(shards)).cast("long"))
        .repartition(min(shards, 100_000), "shard")
        .sortWithinPartitions("shard", F.desc("length"), "number", "start")
        .mapInArrow(tidy(_packer(capacity)), schema)
    )
