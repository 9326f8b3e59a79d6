"""Exact top-k inner products by block-at-a-time pruning.

Candidates are dealt to lanes, queries to chunks, and every (lane, chunk) pair is one unit of
work of bounded size. In a unit the candidates are sorted by id and cut into ranges, the
blocks. A block keeps the largest and smallest value of each dimension (its term maxima) and
a forward index, the block's matrix. A query's sum of term maxima bounds every score in a
block. Each query visits blocks by falling bounds, scores a block as a whole, and stops when
the next bound is below its k-th score, which is exact: ties are visited. A unit returns k
rows per query, and the best k of all units follow.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spendscope.session import stored

LANE_ROWS = 8192
CHUNK_ROWS = 1024
BLOCK_ROWS = 256


def quantized(vector: Column, factor: int = 256) -> Column:
    """floor(factor * x) of each component, as long; NULL unless all components are finite numbers."""
    clean = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.when(clean, F.transform(vector, lambda x: F.floor(x.cast("double") * factor).cast("long")))


def _matrix(vectors: pa.ChunkedArray, width: int) -> np.ndarray:
    """Rows of equal width; shorter vectors are filled up with zeros."""
    out = np.zeros((len(vectors), width), np.int64)
    flat = vectors.combine_chunks() if isinstance(vectors, pa.ChunkedArray) else vectors
    sizes = flat.value_lengths().to_numpy(zero_copy_only=False)
    out[np.arange(width) < sizes[:, None]] = flat.flatten().to_numpy(zero_copy_only=False)
    return out


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best columns of each row: highest score, then smallest id."""
    order = np.lexsort((ids, -scores), axis=1)[:, :k]
    return np.take_along_axis(scores, order, 1), np.take_along_axis(ids, order, 1)


#: The score of a missing place, and its id. The score can be negated.
MISSING, NO_ID = -np.iinfo(np.int64).max, np.iinfo(np.int64).max


def block_search(
    query: np.ndarray, query_id: np.ndarray, doc: np.ndarray, doc_id: np.ndarray, k: int, block: int = BLOCK_ROWS
) -> tuple[np.ndarray, np.ndarray, int]:
    """Scores and ids of each query's k best documents, and how many (query, block) pairs were scored.

    ``doc_id`` ascends. Missing places have the smallest possible score.
    """
    starts = np.arange(0, len(doc), block)
    top, low = np.maximum.reduceat(doc, starts), np.minimum.reduceat(doc, starts)
    bound = np.maximum(query, 0) @ top.T + np.minimum(query, 0) @ low.T
    visit = np.argsort(-bound, axis=1, kind="stable")
    best = np.full((len(query), k), MISSING, np.int64)
    ids = np.full((len(query), k), NO_ID, np.int64)
    scored = 0
    live = np.arange(len(query))
    # Floating point is exact for sums of this size, and much faster.
    size = int(np.abs(query).max(initial=0)) * int(np.abs(doc).max(initial=0)) * max(1, query.shape[1])
    a, b = (query.astype(float), doc.astype(float)) if size < 1 << 53 else (query, doc)
    for turn in range(len(starts)):
        live = live[bound[live, visit[live, turn]] >= best[live, -1]]
        if not len(live):
            break
        scored += len(live)
        at = visit[live, turn]
        order = np.argsort(at, kind="stable")
        cuts = np.flatnonzero(np.diff(at[order])) + 1
        for who in np.split(live[order], cuts):
            start = starts[visit[who[0], turn]]
            own = doc_id[start : start + block]
            scores = (a[who] @ b[start : start + block].T).astype(np.int64)
            scores[query_id[who][:, None] == own] = MISSING
            if scores.shape[1] > 4 * k:
                # Columns that cannot reach the k best of their row, ties included, go first.
                kth = np.maximum(np.partition(scores, -k, axis=1)[:, -k], best[who, -1])
                width = max(int((scores >= kth[:, None]).sum(axis=1).max()), 1)
                pick = np.argsort(-scores, axis=1, kind="stable")[:, :width]
                scores, near = np.take_along_axis(scores, pick, 1), own[pick]
            else:
                near = np.broadcast_to(own, scores.shape)
            near = np.where(scores == MISSING, NO_ID, near)
            best[who], ids[who] = _best(np.hstack([best[who], scores]), np.hstack([ids[who], near]), k)
    return best, ids, scored


_HITS = "query_id long, query_no long, vec_id long, score long"


def _searcher(k: int):
    def search(docs: pa.Table, queries: pa.Table) -> pa.Table:
        names = ["query_id", "query_no", "vec_id", "score"]
        if not docs.num_rows or not queries.num_rows:
            return pa.table({n: pa.array([], pa.int64()) for n in names})
        docs = docs.sort_by("id")
        width = max(pc.max(pc.list_value_length(t["vector"])).as_py() for t in (docs, queries))
        ids, query_ids = docs["id"].to_numpy(), queries["id"].to_numpy()
        best, found, _ = block_search(_matrix(queries["vector"], width), query_ids, _matrix(docs["vector"], width), ids, k)
        row, place = np.nonzero(best > MISSING)
        columns = [query_ids[row], queries["number"].to_numpy()[row], found[row, place], best[row, place]]
        return pa.table(dict(zip(names, map(pa.array, columns))))

    return search


def top_k(
    vectors: DataFrame, is_query: Column, k: int = 5, id: str = "vec_id", vector: str = "embedding",
    lane_rows: int = LANE_ROWS, chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """The ``k`` rows with the highest integer inner product for each query row.

    Columns: ``query_id``, ``rank`` (from 1), ``vec_id``, ``score``. ``is_query`` is a condition
    on the columns of ``vectors``. Rows with the query's own id are not its candidates. Ties go
    to the smaller id. Vectors that are NULL or hold anything but finite numbers take no part,
    nor do rows without an id; a shorter vector counts as filled up with zeros. Scores beyond
    64 bits wrap. Writes the whole-number vectors to a scratch table.
    """
    rows = vectors.select(F.col(id).cast("long").alias("id"), quantized(F.col(vector)).alias("vector"), is_query.alias("asks"))
    rows = stored(rows.where("id is not null and vector is not null").withColumn("number", F.monotonically_increasing_id()), "vectors")
    asking = rows.where("asks")
    lanes, chunks = (max(1, -(-df.count() // n)) for df, n in ((rows, lane_rows), (asking, chunk_rows)))

    def dealt(df: DataFrame, own: str, n: int, other: str, m: int) -> DataFrame:
        # Each row goes to one part of its own kind, and there meets every part of the other.
        return df.withColumn(own, F.pmod(F.xxhash64("number"), F.lit(n))).withColumn(
            other, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(m - 1).cast("long")))
        )

    docs = dealt(rows.select("id", "number", "vector"), "lane", lanes, "chunk", chunks)
    queries = dealt(asking.select("id", "number", "vector"), "chunk", chunks, "lane", lanes)
    hits = docs.groupBy("lane", "chunk").cogroup(queries.groupBy("lane", "chunk")).applyInArrow(_searcher(k), _HITS)
    order = Window.partitionBy("query_id", "query_no").orderBy(F.desc("score"), "vec_id")
    ranked = hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
