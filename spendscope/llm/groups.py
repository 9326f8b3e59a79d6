"""Groups of adjacent rows in a stream of Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa


def sorted_groups(batches: Iterator[pa.RecordBatch], keys: Sequence[str]) -> Iterator[pa.Table]:
    """The groups of rows that agree in ``keys`` (integers), in a stream sorted by them.

    Holds one group at a time, and the batch it ends in.
    """
    held: list[pa.RecordBatch] = []

    def key(batch: pa.RecordBatch, row: int) -> list[int]:
        return [batch.column(k)[row].as_py() for k in keys]

    for batch in batches:
        if not batch.num_rows:
            continue
        if held and key(held[0], 0) != key(batch, 0):
            yield pa.Table.from_batches(held)
            held = []
        columns = [batch.column(k).to_numpy() for k in keys]
        change = np.zeros(batch.num_rows - 1, bool)
        for c in columns:
            change |= c[1:] != c[:-1]
        cuts = np.flatnonzero(change) + 1
        start = 0
        for cut in cuts:
            yield pa.Table.from_batches([*held, batch.slice(start, cut - start)])
            held, start = [], cut
        held.append(batch.slice(start))
    if held:
        yield pa.Table.from_batches(held)
