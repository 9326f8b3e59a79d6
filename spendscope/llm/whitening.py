"""Whitening of vectors by eigenvectors in mixed precision.

1. The whole-number vectors are made distinct and written. One pass adds up their dimensions,
   a second one the products of their deviations from the rounded means, task by task. Both
   are exact: products run as float64 matrix products in blocks short enough for whole numbers,
   and the tasks' sums are whole numbers of any size, so the order of rows changes nothing.
2. The covariance has a row and a column per dimension. Its eigenvectors are found in float32
   and corrected by Ogita-Aishima iterations, which consist of matrix products in ``HIGH``
   precision and converge quadratically. Eigenvalues that lie too close for the correction's
   quotient make a cluster; the matrix within a cluster, shifted by the cluster's mean and
   scaled up, is solved on its own and its vectors are turned accordingly.
3. The few leading vectors go to all tasks, and each vector is projected where it lies.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendscope.llm.batches import in_small_batches
from spendscope.llm.topk import quantized
from spendscope.session import stored

COMPONENTS = 4
#: 64 bits of mantissa on x86; where it is no wider than double, the result is a plain double one.
HIGH = np.longdouble
#: Corrections at most; five take float32 to any precision unless eigenvalues are clustered.
TURNS = 30
#: Eigenvalues nearer than this, relative to the matrix, belong to one cluster.
NEAR = 2.0**-26
LONG_MAX = np.iinfo(np.int64).max


def rows_of(vectors: pa.Array, width: int) -> np.ndarray:
    """A matrix of whole numbers from lists of one width."""
    return vectors.flatten().to_numpy(zero_copy_only=False).reshape(len(vectors), width)


def _whole(x: np.ndarray, factor: int, minus: list[int]) -> np.ndarray:
    """``factor * x - minus`` exactly: as 64-bit numbers if they fit, else as Python's."""
    largest = max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0))))
    if factor * largest + max((abs(m) for m in minus), default=0) <= LONG_MAX:
        return x * factor - np.array(minus, np.int64)
    return x.astype(object) * factor - np.array(minus, object)


def squares(x: np.ndarray) -> np.ndarray:
    """The exact product of the transpose of ``x`` with ``x``, as Python's whole numbers."""
    largest = max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0)))) or 1
    total = np.zeros((x.shape[1], x.shape[1]), object)
    step = (1 << 53) // largest**2
    if not step:
        own = x.astype(object)
        return own.T @ own
    for low in range(0, len(x), step):
        part = x[low : low + step].astype(float)
        total += (part.T @ part).astype(np.int64).astype(object)
    return total


def _text(numbers: np.ndarray) -> str:
    return ",".join(map(str, numbers.tolist()))


def _sums(width: int):
    """Number of rows (in place -1) and sum per dimension of a task's vectors."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros(width, object)
        for batch in batches:
            x = rows_of(batch.column("x"), width)
            n += len(x)
            total += x.astype(object).sum(axis=0) if len(x) else 0
        if n:
            values = [str(n), *map(str, total.tolist())]
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(-1, width), pa.int32()), pa.array(values)], ["place", "sums"])

    return add


def _products(width: int, middle: list[int]):
    """The rows of a task's sum of products of deviations from ``middle``."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width), object)
        for batch in batches:
            total += squares(_whole(rows_of(batch.column("x"), width), 1, middle))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width), pa.int32()), pa.array(map(_text, total))], ["place", "sums"])

    return add


def _add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sums of the lists of each place; a place's rows are all here, one after the other."""
    place, total = None, None

    def done() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([place], pa.int32()), pa.array([_text(total)])], ["place", "sums"])

    for batch in batches:
        for p, sums in zip(batch.column("place").to_pylist(), batch.column("sums").to_pylist()):
            own = np.array([int(v) for v in sums.split(",")], object)
            if p != place:
                if place is not None:
                    yield done()
                place, total = p, own
            else:
                total = total + own
    if place is not None:
        yield done()


_SUMS = "place int, sums string"


def _collected(distinct: DataFrame, add) -> dict[int, list[int]]:
    """The sums of all tasks by place: a list per dimension, whatever the number of vectors."""
    parts = distinct.mapInArrow(add, _SUMS)
    added = parts.repartition("place").sortWithinPartitions("place").mapInArrow(_add_up, _SUMS)
    return {r.place: [int(v) for v in r.sums.split(",")] for r in added.collect()}


def _high(number: int | Fraction) -> np.longdouble:
    """The nearest number of high precision, in three parts of 53 bits."""
    total, rest = HIGH(0), Fraction(number)
    for _ in range(3):
        part = float(rest)
        total, rest = total + HIGH(part), rest - Fraction(part)
    return total


def _slices(m: np.ndarray, axis: int, bits: int) -> list[np.ndarray]:
    """Float64 matrices that add up to ``m``, each with ``bits`` bits in a row (axis 1) or column (axis 0)."""
    out = []
    for _ in range(-(-np.finfo(HIGH).nmant // bits) + 1):
        _, place = np.frexp(np.abs(m).max(axis=axis, keepdims=True))
        unit = np.ldexp(HIGH(1), place - bits)
        part = np.rint(m / unit) * unit
        out.append(part.astype(float))
        m = m - part
    return out


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The matrix product in high precision, from float64 products that are exact."""
    bits = (52 - math.ceil(math.log2(a.shape[1] + 1))) // 2
    left, right = _slices(a, 1, bits), _slices(b, 0, bits)
    total = np.zeros((a.shape[0], b.shape[1]), HIGH)
    for place in reversed(range(len(left))):
        for i in range(place + 1):
            total += left[i] @ right[place - i]
    return total


def _clusters(near: np.ndarray) -> list[np.ndarray]:
    """Runs of two or more neighbours; ``near[i]`` says whether i and i + 1 belong together."""
    cuts = np.flatnonzero(~near) + 1
    return [run for run in np.split(np.arange(len(near) + 1), cuts) if len(run) > 1]


def eigen(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Falling eigenvalues and unit eigenvectors (columns) of a symmetric matrix of ``HIGH`` numbers."""
    d = len(v)
    scale = np.abs(v).max(initial=HIGH(0))
    if not scale > 0:
        return np.zeros(d, HIGH), np.eye(d, dtype=HIGH)
    a = v / scale
    _, start = np.linalg.eigh(a.astype(np.float32))
    x, one = start.astype(HIGH)[:, ::-1], np.eye(d, dtype=HIGH)
    eps = np.finfo(HIGH).eps
    solved: set[tuple[int, int]] = set()
    before = HIGH(np.inf)
    for _ in range(TURNS):
        ax = product(a, x)
        r, s = one - product(x.T, x), product(x.T, ax)
        r, s = (r + r.T) / 2, (s + s.T) / 2
        values = np.diag(s) / (1 - np.diag(r))
        off = s - np.diag(values)
        limit = np.maximum(2 * (np.sqrt((off * off).sum()) + np.sqrt((r * r).sum())), NEAR)
        gap = values[None, :] - values[:, None]
        apart = np.abs(gap) > limit
        e = np.where(apart, (s + values[None, :] * r) / np.where(apart, gap, 1), r / 2)
        x = x + product(x, e)
        change = np.abs(e).max()
        order = np.argsort(-values, kind="stable")
        x, values = x[:, order], values[order]
        if change < 1e-9:
            # Within a cluster the quotient says nothing: its own, shifted matrix is solved.
            for run in _clusters(np.abs(np.diff(values)) <= limit):
                if (int(run[0]), int(run[-1])) in solved:
                    continue
                solved.add((int(run[0]), int(run[-1])))
                own = x[:, run]
                inner = product(own.T, product(a, own) - own * values[run].mean())
                size = np.abs(inner).max()
                if size > 0:
                    _, turn = np.linalg.eigh(((inner + inner.T) / (2 * size)).astype(float))
                    x[:, run] = product(own, turn[:, ::-1].astype(HIGH))
                    change = HIGH(1)
        if change <= 4 * eps or (change < 1e-15 and change >= before):
            break
        before = change
    values = np.diag(product(x.T, product(a, x))) / (x * x).sum(axis=0)
    order = np.argsort(-values, kind="stable")
    x, values = x[:, order], values[order]
    x = x / np.sqrt((x * x).sum(axis=0))
    sign = np.where(x[np.abs(x).argmax(axis=0), np.arange(d)] < 0, HIGH(-1), HIGH(1))
    return values * scale, x * sign


@dataclass(frozen=True)
class Whitening:
    """What is learnt: number of vectors, sums, leading eigenvalues, vectors (columns) and shares."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    explained: np.ndarray

    @property
    def width(self) -> int:
        return len(self.sums)

    def apply(self, x: np.ndarray) -> tuple[list[int | None], np.ndarray]:
        """The exact squared distance of ``n * x`` from the sums (None beyond 64 bits), and the whitened rows.

        A component without variance gives NaN.
        """
        off = _whole(x, self.n, self.sums)
        largest = max((abs(int(v)) for v in (off.max(initial=0), off.min(initial=0))), default=0)
        if largest**2 * self.width <= LONG_MAX:
            deviation = (off * off).sum(axis=1).tolist()
        else:
            exact = off.astype(object)
            deviation = [v if v <= LONG_MAX else None for v in (exact * exact).sum(axis=1).tolist()]
        with np.errstate(divide="ignore", invalid="ignore"):
            inverse = np.where(self.values > 0, 1 / np.sqrt(self.values), np.nan)
        # Added up by dimension: a matrix product's last bit depends on where in a batch a row lies.
        centred, white = off.astype(float) / self.n, np.zeros((len(x), len(self.values)))
        for own, vector in zip(centred.T, self.vectors):
            white += own[:, None] * vector
        return deviation, white * inverse


def vectors_of(df: DataFrame, id: str, vector: str, factor: int = 256) -> DataFrame:
    """Rows (id, x): the whole-number vectors, shorter ones filled up with zeros."""
    rows = df.select(F.col(id).alias("id"), quantized(F.col(vector), factor).alias("x")).where("x is not null")
    width = rows.agg(F.max(F.size("x"))).first()[0] or 0
    filled = F.concat("x", F.array_repeat(F.lit(0).cast("long"), F.lit(width) - F.size("x")))
    return rows.withColumn("x", F.when(F.size("x") < width, filled).otherwise(F.col("x"))).withColumn("width", F.lit(width))


def fit(distinct: DataFrame, width: int, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of vectors ``x`` that are all different; None if there are none.

    Only sums by dimension and by pair of dimensions come to the driver.
    """
    sums = _collected(distinct, _sums(width))
    if not sums or not width:
        return None
    n, total = sums[-1][0], [sums[i][0] for i in range(width)]
    middle = [(2 * s + n) // (2 * n) for s in total]
    products = _collected(distinct, _products(width, middle))
    rest = [s - n * m for s, m in zip(total, middle)]
    # n * n times the covariance, in whole numbers.
    exact = [[n * products[i][j] - rest[i] * rest[j] for j in range(width)] for i in range(width)]
    v = np.array([[_high(Fraction(c, n * n)) for c in row] for row in exact], HIGH)
    trace = sum(exact[i][i] for i in range(width))
    values, x = eigen(v)
    keep = min(components, width)
    values = values[:keep]
    # A rank below the width leaves rounding errors where there is no variance.
    values = np.where(values > 256 * width * np.finfo(float).eps * np.abs(values).max(), values, 0)
    share = [float(value / _high(Fraction(trace, n * n))) if trace else 0.0 for value in values]
    return Whitening(n, total, values.astype(float), x[:, :keep].astype(float), np.array(share))


def _second_moments(model: Whitening):
    """A task's sums of the whitened vectors and of their products, exactly rounded."""
    keep = len(model.values)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[list[float]] = []
        for batch in batches:
            _, w = model.apply(rows_of(batch.column("x"), model.width))
            parts.append([*w.sum(axis=0), *(w.T @ w).ravel()])
        if parts:
            sums = [math.fsum(p) for p in zip(*parts)]
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(keep + keep**2), pa.int32()), pa.array(sums)], ["place", "part"])

    return add


def identity_error(distinct: DataFrame, model: Whitening) -> float | None:
    """The largest absolute entry of the whitened vectors' covariance minus the identity.

    Components without variance take no part; without any other the result is None.
    """
    parts = distinct.mapInArrow(_second_moments(model), "place int, part double")
    sums = {r.place: r.total for r in parts.groupBy("place").agg(F.sum("part").alias("total")).collect()}
    keep, used = len(model.values), np.flatnonzero(model.values > 0)
    if not len(used):
        return None
    mean = np.array([sums[i] for i in range(keep)]) / model.n
    second = np.array([sums[keep + i] for i in range(keep**2)]).reshape(keep, keep) / model.n
    error = second - np.outer(mean, mean) - np.eye(keep)
    return float(np.abs(error[np.ix_(used, used)]).max())


def _applier(model: Whitening, error: float | None):
    keep = len(model.values)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            deviation, w = model.apply(rows_of(batch.column("x"), model.width))
            rows = len(w)
            names = ["component", "n", "deviation", "whitened", "explained", "identity_error"]
            columns = [
                pa.array(np.tile(np.arange(1, keep + 1), rows), pa.int32()),
                pa.array(np.full(rows * keep, model.n), pa.int64()),
                pa.array(deviation, pa.int64()).take(pa.array(np.repeat(np.arange(rows), keep))),
                pa.array(w.ravel(), from_pandas=True),
                pa.array(np.tile(model.explained, rows)),
                pa.array([error] * (rows * keep), pa.float64()),
            ]
            id = batch.column("id").take(pa.array(np.repeat(np.arange(rows), keep)))
            yield pa.RecordBatch.from_arrays([id, *columns], ["id", *names])

    return apply


def whiten(df: DataFrame, id: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS, factor: int = 256) -> DataFrame:
    """Each vector's leading whitened components.

    A vector's entries become ``floor(factor * c)``; the whitening is learnt from the distinct
    ones. Columns: ``id``, ``component`` (from 1, by falling variance), ``n`` (distinct vectors),
    ``deviation`` (exact sum of the squares of n * x less the sums; NULL beyond 64 bits),
    ``whitened``, ``explained`` (share of the variance), ``identity_error``.

    Vectors that are NULL or hold anything but finite numbers give no rows; repeated rows and
    rows without an id give their own. Shorter vectors count as filled up with zeros. There are
    at most as many components as dimensions. A component without variance has NULL for
    ``whitened`` and 0 for ``explained``. Equal eigenvalues leave the choice of vectors open.
    The distinct vectors are written to a scratch table.
    """
    schema = f"id {dict(df.dtypes)[id]}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    rows = in_small_batches(vectors_of(df, id, vector, factor))
    width = rows.select("width").first()
    distinct = stored(rows.select("x").distinct(), "distinct_vectors")
    model = fit(distinct, width[0], components) if width else None
    if model is None:
        return df.sparkSession.createDataFrame([], schema)
    error = identity_error(distinct, model)
    return rows.select("id", "x").mapInArrow(_applier(model, error), schema)
