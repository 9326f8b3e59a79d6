"""Words and word sequences as 64-bit hashes, many texts at a time.

Runs inside Spark's Arrow tasks. Texts are handled in blocks of about ``BLOCK`` bytes, so the
arrays stay small however long a batch is; a single text may be longer than a block.

Hashes mix after every step, so no pattern of bytes or words makes them collide: two words, or
two word sequences, have one hash with a probability of 2**-64. They count as equal then.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import xxhash

BLOCK = 1 << 18
U64 = np.uint64
ODD = U64(0x9E3779B97F4A7C15)
#: Bytes of a word above which it is hashed on its own.
LONG = 64


@dataclass(frozen=True)
class Split:
    """Which bytes separate words, and what each byte is hashed as."""

    separator: np.ndarray  # bool per byte value
    folded: np.ndarray  # uint8 per byte value


def _split(separators: bytes, lower: bool) -> Split:
    separator = np.zeros(256, bool)
    separator[list(separators)] = True
    folded = np.arange(256, dtype=np.uint8)
    if lower:
        folded[65:91] += 32
    return Split(separator, folded)


WHITE = b"\t\n\x0b\x0c\r "
#: Everything in ASCII but letters and digits.
MARKS = bytes(c for c in range(128) if not chr(c).isalnum())
PLAIN = _split(WHITE, lower=False)
LOWER = _split(WHITE, lower=True)
LOWER_ALNUM = _split(MARKS, lower=True)


def mix(x: np.ndarray) -> np.ndarray:
    """Scrambles 64-bit values; no two values meet."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


_FIRST_BYTES = np.array([(1 << 8 * n) - 1 for n in range(9)], U64)


def bytes_hash(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """One hash for each range [start, end) of bytes, taken in eight at a time."""
    padded = np.concatenate([raw, np.zeros(8, np.uint8)])
    eight = np.ndarray(len(raw) + 1, "<u8", padded, strides=(1,))
    length = end - start
    out = mix(length.astype(U64) + ODD)
    rest, done = np.flatnonzero((length > 0) & (length <= LONG)), 0
    while len(rest):
        left = length[rest] - done
        part = eight[start[rest] + done] & _FIRST_BYTES[np.minimum(left, 8)]
        out[rest] = mix(out[rest] * ODD + part)
        rest, done = rest[left > 8], done + 8
    for i in np.flatnonzero(length > LONG):
        out[i] = xxhash.xxh3_64_intdigest(padded[start[i] : end[i]])
    return out


def _join(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return mix(mix(left * ODD + U64(1)) + right)


def spans_hash(values: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """One hash for each range [start, end) of 64-bit ``values``, whatever its place.

    Hashes of 2, 4, 8 … values are joined from halves; a range joins the two of the largest
    such size that cover it.
    """
    length = end - start
    out = mix(length.astype(U64) + ODD)
    level, size, longest = values, 1, int(length.max(initial=0))
    while size <= longest:
        own = np.flatnonzero((length >= size) & (length < 2 * size))
        out[own] = _join(out[own], _join(level[start[own]], level[end[own] - size]))
        if 2 * size <= longest:
            level = _join(level[:-size], level[size:])
        size *= 2
    return out


def windows_hash(values: np.ndarray, width: int) -> np.ndarray:
    """The hash of the ``width`` values from each place; one for each place where they fit."""
    start = np.arange(max(0, len(values) - width + 1))
    return spans_hash(values, start, start + width)


@dataclass
class Words:
    """The words of some texts: ``first[i]:first[i + 1]`` are those of text ``row + i``."""

    row: int
    raw: np.ndarray
    text: np.ndarray  # where each text starts in raw, and the end
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray
    split: Split

    @cached_property
    def hash(self) -> np.ndarray:
        return bytes_hash(self.split.folded[self.raw], self.start, self.end)

    def __len__(self) -> int:
        return len(self.first) - 1

    def bounds(self) -> Iterator[tuple[int, int, int]]:
        """Row, first word and end of each text."""
        for i in range(len(self)):
            yield self.row + i, self.first[i], self.first[i + 1]


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    texts = (texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts).cast(pa.large_binary())
    if texts.null_count:
        texts = texts.fill_null(b"")
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    return np.frombuffer(data, np.uint8) if data and data.size else np.zeros(0, np.uint8), at


def split_words(texts: pa.Array, split: Split, block: int = BLOCK) -> Iterator[Words]:
    """The words of all texts, some texts at a time; NULL has none."""
    data, at = buffers(texts)
    row, rows = 0, len(at) - 1
    while row < rows:
        upto = max(row + 1, int(np.searchsorted(at, at[row] + block, "right")) - 1)
        upto = min(upto, rows)
        raw = data[at[row] : at[upto]]
        text = at[row : upto + 1] - at[row]
        n = len(raw)
        inside = np.zeros(n + 2, bool)
        np.logical_not(split.separator[raw], out=inside[1:-1])
        edge = np.zeros(n + 1, bool)  # a text starts or ends here
        edge[text] = True
        start = np.flatnonzero(inside[1:] & (~inside[:-1] | edge))
        end = np.flatnonzero(inside[:-1] & (~inside[1:] | edge))
        yield Words(row, raw, text, start, end, np.searchsorted(start, text), split)
        row = upto


def as_long(hashes: np.ndarray) -> np.ndarray:
    return hashes.view(np.int64)
