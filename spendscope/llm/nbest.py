"""N-best segmentation into SentencePiece pieces, and decoding.

Over the lattice of all pieces that fit a text, a forward Viterbi pass gives the best score of
a path to each place. These scores are exact heuristics for a backward A* search, which yields
the best paths to the end one after the other.

No piece of the vocabulary reaches over a line feed, or over a space that follows another
character, so the lattice falls into units: a word with the spaces before it. The Viterbi passes
of all new units of some texts run at once on arrays, forward and backward, which gives a
unit's best path and how much its second-best path loses. The N best paths of a text differ from
the best one only in the N - 1 units that lose least; A* runs on the lattices of these, and their
paths are combined. The arrays hold the units side by side, one depth after the other, and all
units walk a trie of the pieces from one depth at once.

A piece's score is ``-ln(2 + rank)`` by its place in the vocabulary, which lists merges by
falling frequency, in millionths so that sums are exact. A character that is no piece is
spelled in byte pieces, at 10 less than the worst piece each.
"""

from __future__ import annotations

import heapq
import math
import zlib
from collections.abc import Iterator
from hashlib import sha256
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendscope.llm.batches import in_small_batches, tidy
from spendscope.llm.words import bytes_hash

UNIT = 1_000_000
#: Bytes of a unit up to which it is handled on arrays; longer ones are rare. Both ways find the same paths.
SHORT = 64
#: Bytes of texts that are segmented together.
BLOCK = 1 << 22
#: Units that a task remembers.
REMEMBERED = 1 << 19
NEVER = np.iinfo(np.int64).min // 4


class Vocabulary:
    """The pieces of a model: as bytes with a space for its mark, with scores and ids."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        self.spelled: list[bytes] = []
        self.byte = np.zeros(256, np.int32)
        self.piece: dict[bytes, tuple[int, int]] = {}
        for i in range(model.get_piece_size()):
            name = model.id_to_piece(i)
            if model.is_byte(i):
                value = int(name[3:5], 16)
                self.byte[value] = i
                self.spelled.append(bytes([value]))
            elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                self.spelled.append(b"")
            else:
                own = name.replace("▁", " ").encode()
                # A text is cut before each line feed, behind it, and before a space that follows another character.
                if b" " in own.lstrip(b" ") or (b"\n" in own and own != b"\n"):
                    raise ValueError(f"piece {name!r} reaches over the border of two units")
                self.spelled.append(own)
                self.piece[own] = (-round(math.log(2 + len(self.piece)) * UNIT), i)
        self.byte_score = min(s for s, _ in self.piece.values()) - 10 * UNIT
        self._plant()
        self.lengths = sorted(set(map(len, self.piece)))
        self.pieces = pa.array(self.spelled, pa.binary())

    def _plant(self) -> None:
        """A trie of the pieces: a row of the table holds the next nodes of a node, by letter; 0 is none, 1 the root."""
        below: list[dict[int, int]] = [{}, {}]
        ends = {}
        for text, own in self.piece.items():
            node = 1
            for byte in text:
                node = below[node].setdefault(byte, len(below))
                if node == len(below):
                    below.append({})
            ends[node] = own
        # Nodes with others below them come first; only these have rows.
        order = sorted(range(len(below)), key=lambda n: n > 1 and not below[n])
        number = {n: i for i, n in enumerate(order)}
        self.rows = sum(n < 2 or bool(below[n]) for n in order)
        self.letter = np.zeros(256, np.intp)
        used = sorted({byte for row in below for byte in row})
        self.letter[used] = np.arange(1, len(used) + 1)
        self.next = np.zeros((self.rows, len(used) + 1), np.min_scalar_type(len(order)))
        for n in order[: self.rows]:
            for byte, m in below[n].items():
                self.next[number[n], self.letter[byte]] = number[m]
        # 0: no piece ends here.
        self.node_score, self.node_id = np.zeros(len(order), np.int64), np.zeros(len(order), np.int32)
        for n, own in ends.items():
            self.node_score[number[n]], self.node_id[number[n]] = own

    def edges(self, unit: bytes, end: int) -> Iterator[tuple[int, int]]:
        """Where the pieces start that end at ``end``, and their scores."""
        if end < len(unit) and unit[end] & 0xC0 == 0x80:
            return
        for length in self.lengths:
            found = self.piece.get(unit[end - length : end]) if length <= end else None
            if found:
                yield end - length, found[0]
        start = end - 1
        while start and unit[start] & 0xC0 == 0x80:
            start -= 1
        if unit[start:end] not in self.piece:
            yield start, self.byte_score * (end - start)

    def ids(self, unit: bytes, places: list[int]) -> list[int]:
        out: list[int] = []
        for a, b in zip(places, places[1:]):
            found = self.piece.get(unit[a:b])
            out += [found[1]] if found else self.byte[list(unit[a:b])].tolist()
        return out

    def search(self, unit: bytes, n: int) -> list[tuple[int, list[int]]]:
        """The ``n`` best segmentations: scores and ids, best first.

        Of equal bounds the entry nearest the start comes first, so the best path is found
        without looking at others as good, and it is the one that ``best`` gives: from the
        end, each piece is the longest of those on a best path. No place lies on more than
        ``n`` of the paths to be found with different ends, so later visits are skipped.
        """
        best = [0] + [NEVER] * len(unit)
        into: list[list[tuple[int, int]]] = [[]]
        for end in range(1, len(unit) + 1):
            into.append([(s, w) for s, w in self.edges(unit, end) if best[s] > NEVER])
            best[end] = max((best[s] + w for s, w in into[end]), default=NEVER)
        # Entries: negative bound, place, order of entry (newest first), score behind it, places behind it.
        heap: list[tuple] = [(-best[-1], len(unit), 0, 0, (len(unit), None))]
        visits = [0] * (len(unit) + 1)
        out, entered = [], 0
        while heap and len(out) < n:
            _, place, _, behind, path = heapq.heappop(heap)
            visits[place] += 1
            if place == 0:
                places = []
                while path:
                    places.append(path[0])
                    path = path[1]
                out.append((behind, self.ids(unit, places)))
                continue
            if visits[place] > n:
                continue
            for start, score in into[place]:
                entered -= 1
                heapq.heappush(heap, (-(best[start] + behind + score), start, entered, behind + score, (start, path)))
        return out

    def best(self, raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Viterbi passes over the units ``raw[at[i]:at[i + 1]]`` at once.

        Best score, loss of the second-best path (or -1), ids, and where each unit's ids start.
        """
        units, size = len(at) - 1, len(raw)
        length = np.diff(at)
        longest = int(length.max(initial=0))
        # By falling length, the units with a node at depth j are the first wide[j], and lie side by side in all arrays.
        order = np.argsort(-length, kind="stable")
        begin = at[:-1][order]
        wide = np.append(np.searchsorted(-length[order], -np.arange(longest + 1), "right"), 0)
        node = np.concatenate([[0], np.cumsum(wide)])
        at_depth = [slice(a, b) for a, b in zip(node[:-1], node[1:])]
        ending = [slice(b, a) for a, b in zip(wide[:-1], wide[1:])]
        letters = [self.letter[raw[begin[:w] + j]] for j, w in enumerate(wide[1:-1])]
        heads = (raw & 0xC0) != 0x80
        heads[at[:-1][length > 0]] = True
        head = np.flatnonzero(heads)
        char = np.zeros(size, np.int64)
        char[head] = np.diff(head, append=size)

        forward = np.full(node[-1], NEVER)
        forward[at_depth[0]] = 0
        chosen = np.zeros(node[-1], np.int8 if longest < 128 else np.int64)
        chosen_id = np.zeros(node[-1], np.int32)
        edges: list[tuple[int, int, np.ndarray, np.ndarray | int]] = []

        def enter(j: int, n: int, own: np.ndarray, score: np.ndarray | int, id: np.ndarray | int) -> None:
            """Pieces of ``n`` bytes from depth ``j``, at most one in a unit; of paths as good, the longest piece stays."""
            edges.append((j, n, own, score))
            reach = forward[at_depth[j]][own] + score
            target = own + node[j + n]
            better = np.flatnonzero(reach > forward[target])
            target = target[better]
            forward[target] = reach[better]
            chosen[target] = n
            chosen_id[target] = id[better] if isinstance(id, np.ndarray) else id

        for j, letter in enumerate(letters):
            bare = char[begin[: len(letter)] + j]  # bytes of the character here, 0 if it is a piece
            state = self.next[1, letter]
            own = np.flatnonzero(state)
            state = state[own]
            for n in range(1, longest - j + 1):
                score = self.node_score[state]
                hit = np.flatnonzero(score)
                if len(hit):
                    found = own[hit]
                    enter(j, n, found, score[hit], self.node_id[state[hit]])
                    if n <= 4:
                        bare[found[bare[found] == n]] = 0
                # On to the next byte, where there is one.
                upto = np.searchsorted(own, wide[j + n + 1]) if n < longest - j else 0
                going = np.flatnonzero(state[:upto] < self.rows)
                own = own[going]
                state = self.next[state[going], letters[j + n][own]] if len(going) else state[:0]
                alive = np.flatnonzero(state)
                if not len(alive):
                    break
                own, state = own[alive], state[alive]
            # Characters that are no piece.
            for n in np.flatnonzero(np.bincount(bare)[1:]) + 1 if bare.any() else ():
                enter(j, n, np.flatnonzero(bare == n), self.byte_score * int(n), -1)

        # The best paths from their ends.
        on_best = np.zeros(node[-1], bool)
        total, path_length, path_id = np.zeros(units, np.int64), np.zeros(size, chosen.dtype), np.zeros(size, np.int32)
        backward = np.full(node[-1], NEVER)
        for j in range(longest, -1, -1):
            total[order[ending[j]]] = forward[at_depth[j]][ending[j]]
            backward[at_depth[j]][ending[j]] = 0
            on_best[at_depth[j]][ending[j]] = True
            if j:
                own = np.flatnonzero(on_best[at_depth[j]])
                n, id = chosen[at_depth[j]][own], chosen_id[at_depth[j]][own]
                start = j - n.astype(np.int64)
                on_best[node[start] + own] = True
                path_length[begin[own] + start] = n
                path_id[begin[own] + start] = id
        other = np.full(units, NEVER)
        for j, n, own, score in reversed(edges):
            target, source = own + node[j + n], own + node[j]
            rest = backward[target] + score
            backward[source] = np.maximum(backward[source], rest)
            off = np.flatnonzero(~on_best[target] | (chosen[target] != n))
            own = own[off]
            other[own] = np.maximum(other[own], forward[source[off]] + rest[off])
        loss = np.full(units, -1)
        loss[order] = np.where(other > NEVER // 2, total[order] - other, -1)

        path = np.flatnonzero(path_length)
        spelled = path_id[path] < 0
        count = np.where(spelled, path_length[path], 1).astype(np.int64)
        out = np.repeat(path_id[path], count)
        place = np.cumsum(count) - count
        for k in range(int(count.max(initial=0)) if spelled.any() else 0):
            own = np.flatnonzero(spelled & (count > k))
            out[place[own] + k] = self.byte[raw[path[own] + k]]
        ids_of = np.append(place, len(out))[np.searchsorted(path, at)]
        return total, loss, out, ids_of

    def decode(self, ids: np.ndarray) -> bytes:
        """The text that the ids spell, without the space that is put before it."""
        if not len(ids):
            return b""
        spelled = self.pieces.take(pa.array(ids))
        _, at, data = spelled.buffers()
        first, last = np.frombuffer(at, np.int32)[[spelled.offset, spelled.offset + len(ids)]].tolist()
        return data.slice(first, last - first).to_pybytes()[1:]


class Segmenter:
    """N-best segmentations of many texts, with the units it has met before in memory."""

    def __init__(self, path: str, n: int):
        self.vocabulary, self.n = Vocabulary(path), n
        self._forget()

    def _forget(self) -> None:
        self.known: dict[int, int] = {}
        self.searched: dict[bytes, list] = {}
        self.score = self.loss = np.zeros(0, np.int64)
        self.ids, self.at = np.zeros(0, np.int32), np.zeros(1, np.int64)

    def _learn(self, hashes: np.ndarray, raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Remembers new units; returns their numbers."""
        short = end - start <= SHORT
        size = (end - start)[short]
        at = np.concatenate([[0], np.cumsum(size)])
        data = raw[np.repeat(start[short] - at[:-1], size) + np.arange(at[-1])]
        score, loss, ids, where = self.vocabulary.best(data, at)
        long = np.flatnonzero(~short)
        if len(long):
            found = [self.vocabulary.search(raw[start[i] : end[i]].tobytes(), 2) for i in long]
            score = np.append(score, [f[0][0] for f in found])
            loss = np.append(loss, [f[0][0] - f[1][0] if len(f) > 1 else -1 for f in found])
            ids = np.append(ids, np.concatenate([f[0][1] for f in found])).astype(np.int32)
            where = np.append(where, where[-1] + np.cumsum([len(f[0][1]) for f in found]))
        numbers = np.empty(len(hashes), np.int64)
        numbers[np.append(np.flatnonzero(short), long)] = np.arange(len(hashes)) + len(self.known)
        self.known.update(zip(hashes.tolist(), numbers.tolist()))
        self.score, self.loss = np.append(self.score, score), np.append(self.loss, loss)
        self.at = np.append(self.at, self.at[-1] + where[1:])
        self.ids = np.append(self.ids, ids)
        return numbers

    def texts(self, texts: list[bytes]) -> Iterator[list[tuple[int, np.ndarray]]]:
        """For each text its best segmentations: scores and ids, best first."""
        row = 0
        while row < len(texts):
            size, upto = 0, row
            while upto < len(texts) and (size < BLOCK or upto == row):
                size += len(texts[upto]) + 1
                upto += 1
            yield from self._block(texts[row:upto])
            row = upto

    def _block(self, texts: list[bytes]) -> Iterator[list[tuple[int, np.ndarray]]]:
        texts = [t.replace(b"\xe2\x96\x81", b" ") for t in texts]
        raw = np.frombuffer(b"".join(b" " + t if t else t for t in texts), np.uint8)
        at = np.concatenate([[0], np.cumsum([len(t) + bool(t) for t in texts])])
        before = np.concatenate([[10], raw[:-1]]).astype(np.uint8) if len(raw) else raw
        new = (raw == 10) | (before == 10) | ((raw == 32) & (before != 32))
        new[at[:-1][at[:-1] < len(raw)]] = True
        start = np.flatnonzero(new)
        end = np.append(start[1:], len(raw))
        first = np.searchsorted(start, at)
        code, distinct = pd.factorize(bytes_hash(raw, start, end))
        if len(self.known) + len(distinct) > REMEMBERED:
            self._forget()
        index = np.fromiter(map(self.known.get, distinct.tolist(), repeat(-1)), np.int64, len(distinct))
        fresh = np.flatnonzero(index < 0)
        if len(fresh):
            where = np.empty(len(distinct), np.int64)
            where[code[::-1]] = np.arange(len(code))[::-1]
            index[fresh] = self._learn(distinct[fresh], raw, start[where[fresh]], end[where[fresh]])
        index = index[code]
        score, loss = self.score[index], self.loss[index]
        count = self.at[index + 1] - self.at[index]
        total = np.concatenate([[0], np.cumsum(count)])
        ids = self.ids[np.repeat(self.at[index] - total[:-1], count) + np.arange(total[-1])]
        for a, b in zip(first[:-1], first[1:]):
            open_units = a + np.flatnonzero(loss[a:b] >= 0)
            if len(open_units) >= self.n:
                order = np.argpartition(loss[open_units], self.n - 2)[: self.n - 1] if self.n > 1 else []
                open_units = np.sort(open_units[order])
            # Each combination: what it loses, and the choice in each open unit.
            combined: list[tuple[int, tuple[int, ...]]] = [(0, ())]
            options = []
            for u in open_units:
                unit = raw[start[u] : end[u]].tobytes()
                found = self.searched.get(unit)
                if found is None:
                    found = self.searched[unit] = self.vocabulary.search(unit, self.n)
                options.append(found)
                more = ((c + found[0][0] - f[0], (*path, j)) for c, path in combined for j, f in enumerate(found))
                combined = heapq.nsmallest(self.n, more)
            out = []
            best = int(score[a:b].sum())
            for lost, path in combined:
                parts, done = [], total[a]
                for u, j, found in zip(open_units, path, options):
                    parts += [ids[done : total[u]], np.array(found[j][1], np.int32)]
                    done = total[u + 1]
                parts.append(ids[done : total[b]])
                out.append((best - lost, np.concatenate(parts)))
            yield out


def _runner(path: str, n: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segmenter = Segmenter(path, n)
        vocabulary = segmenter.vocabulary
        for batch in batches:
            texts = batch.column("body").cast(pa.binary()).to_pylist()
            rows: list[tuple] = []
            for id, found in zip(batch.column("id").to_pylist(), segmenter.texts(texts)):
                for rank, (score, ids) in enumerate(found, 1):
                    crc = zlib.crc32(ids.astype("<u4"))
                    text = sha256(vocabulary.decode(ids)).hexdigest()
                    rows.append((id, rank, score / UNIT, len(ids), crc, text) + ((ids,) if with_ids else ()))
            if rows:
                types = [pa.int64(), pa.int32(), pa.float64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int32())]
                names = ["id", "rank", "score", "n_ids", "ids_crc32", "decoded_sha256", "ids"][: 6 + with_ids]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    return run


def n_best(docs: DataFrame, model: str, n: int = 3, id: str = "doc_id", text: str = "text", with_ids: bool = False) -> DataFrame:
    """The ``n`` best segmentations of each text, all there are if fewer.

    Columns: ``id``, ``rank`` (from 1), ``score``, ``n_ids``, ``ids_crc32`` (unsigned, of the
    ids as little-endian unsigned 32-bit numbers), ``decoded_sha256`` (of the text that the ids
    decode to) and, if asked for, ``ids``. NULL and empty texts have one segmentation without
    ids. The mark U+2581 counts as a space. ``model`` is a SentencePiece file on all machines.
    """
    rows = in_small_batches(docs).select(F.col(id).cast("long").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("body"))
    schema = "id long, rank int, score double, n_ids long, ids_crc32 long, decoded_sha256 string" + ", ids array<int>" * with_ids
    return rows.mapInArrow(tidy(_runner(model, n, with_ids)), schema)
