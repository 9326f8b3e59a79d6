"""Exact dedup by an exchange of Golomb-coded fingerprints.

1. Each task cuts its rows into blocks. A block sorts the distinct fingerprints of its texts
   and sends each owner (a range of fingerprints) its share as one Golomb-Rice message, a few
   bytes per fingerprint instead of whole texts or hashes.
2. An owner decodes what it gets, counts in how many blocks a fingerprint occurs, and answers
   each message with a bitmap: one bit per fingerprint, set if another block has it, too.
3. Rows with a set bit, or with an equal fingerprint in their own block, are suspects. Only
   their texts are shuffled, grouped by SHA-256 and by the text itself, so equality is decided
   on bytes. A heavy group is summed up on the map side, and joined back by a join whose large
   partitions adaptive execution splits.

Suspects are picked from a second scan by a bitmap of fixed size (``members``), so texts
without a copy are never shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendscope.llm.batches import in_small_batches, tidy
from spendscope.llm.groups import sorted_groups
from spendscope.llm.members import bitmap, bits_for, marked
from spendscope.session import stored

#: Of 2e10 different texts, about 7e-5 are suspects for no reason; they cost time only.
FINGERPRINT_BITS = 48
#: Texts for each owner of a range of fingerprints.
OWNER_ROWS = 1 << 21
#: Rows of a block at most; its fingerprints take 8 bytes each while it is coded.
BLOCK_ROWS = 1 << 17


def golomb_encode(values: np.ndarray, span: int) -> bytes:
    """Ascending distinct numbers below ``span`` as a Golomb-Rice code of their gaps.

    A message holds the number of values, the number of low bits per gap, the high parts in
    unary (zeros, then a one), and the low parts in as many bits each.
    """
    n = len(values)
    if not n:
        return b""
    low_bits = max(0, int(span // n).bit_length() - 1)
    gaps = np.diff(values.astype(np.int64), prepend=-1) - 1
    ends = np.cumsum((gaps >> low_bits) + 1)
    unary = np.zeros(ends[-1], np.uint8)
    unary[ends - 1] = 1
    low = (gaps[:, None] >> np.arange(low_bits - 1, -1, -1)) & 1
    head = np.array([n, low_bits, len(unary)], "<i8").tobytes()
    return head + np.packbits(unary).tobytes() + np.packbits(low.astype(np.uint8)).tobytes()


def golomb_decode(message: bytes) -> np.ndarray:
    if not message:
        return np.zeros(0, np.int64)
    n, low_bits, unary_bits = np.frombuffer(message, "<i8", 3).tolist()
    data = np.frombuffer(message, np.uint8, offset=24)
    cut = (unary_bits + 7) // 8
    ends = np.flatnonzero(np.unpackbits(data[:cut], count=unary_bits))
    high = np.diff(ends, prepend=-1) - 1
    low = np.unpackbits(data[cut:], count=n * low_bits).reshape(n, low_bits)
    place = np.int64(1) << np.arange(low_bits - 1, -1, -1, dtype=np.int64)
    return np.cumsum((high << low_bits) + low @ place + 1) - 1


_SENT = "sha binary, block long, owner int, place int, copied boolean, message binary"


def _sender(owners: int, fingerprint_bits: int, block_rows: int):
    """Codes the rows (number, sha) of a task; a message stands on the first row of its share."""
    span = -(-(1 << fingerprint_bits) // owners)

    def block(number: int, shas: list[bytes]) -> pa.RecordBatch:
        top = np.frombuffer(b"".join(s[:8] for s in shas), ">u8").astype(np.uint64)
        prints = (top >> np.uint64(64 - fingerprint_bits)).astype(np.int64)
        order = np.argsort(prints, kind="stable")
        distinct, start, count = np.unique(prints[order], return_index=True, return_counts=True)
        owner = distinct // span
        first = np.searchsorted(owner, np.arange(owners + 1))
        messages: list[bytes | None] = [None] * len(prints)
        for o in np.unique(owner):
            share = distinct[first[o] : first[o + 1]]
            messages[start[first[o]]] = golomb_encode(share - o * span, span)
        of = np.repeat(np.arange(len(distinct)), count)
        columns = [
            pa.array([shas[i] for i in order], pa.binary()),
            pa.array(np.full(len(of), number)),
            pa.array(owner[of].astype(np.int32)),
            pa.array((of - first[owner[of]]).astype(np.int32)),
            pa.array(count[of] > 1),
            pa.array(messages, pa.binary()),
        ]
        return pa.RecordBatch.from_arrays(columns, ["sha", "block", "owner", "place", "copied", "message"])

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[bytes] = []
        number = None  # of the block: that of its first row
        for batch in batches:
            if number is None and batch.num_rows:
                number = batch.column(0)[0].as_py()
            held.extend(batch.column(1).to_pylist())
            while len(held) >= block_rows:
                yield block(number, held[:block_rows])
                held = held[block_rows:]
                number += block_rows
        if held:
            yield block(number, held)

    return send


def _answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bitmaps of each owner, as 64-bit words: what other messages hold, too."""
    for group in sorted_groups(batches, ["owner"]):
        decoded = [golomb_decode(m) for m in group.column("message").to_pylist()]
        distinct, count = np.unique(np.concatenate(decoded), return_counts=True)
        shared = distinct[count > 1]
        answers = []
        for values in decoded:
            bits = np.zeros(-(-len(values) // 64) * 64, np.uint8)
            bits[: len(values)] = np.isin(values, shared, assume_unique=True)
            answers.append(np.packbits(bits, bitorder="little").view("<i8"))
        found = pa.array([bool(a.any()) for a in answers])
        columns = [group.column(c).combine_chunks().filter(found) for c in ("block", "owner")]
        some = pa.array([a for a in answers if a.any()], pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([*columns, some], ["block", "owner", "answer"])


def suspect_hashes(
    docs: DataFrame,
    text: str = "text",
    owners: int | None = None,
    fingerprint_bits: int = FINGERPRINT_BITS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """SHA-256 values (``sha``) of all texts whose fingerprint occurs more than once.

    ``owners`` is the number of fingerprint ranges, by default one for ``OWNER_ROWS`` texts and
    not fewer than there are shuffle partitions. An owner holds 8 bytes a few times over for
    each fingerprint of its range and block.
    """
    owners = owners or max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-docs.count() // OWNER_ROWS))
    sent = stored(
        in_small_batches(docs).select(F.monotonically_increasing_id().alias("number"), _sha(F.col(text)).alias("sha")).mapInArrow(
            tidy(_sender(owners, fingerprint_bits, block_rows)), _SENT
        ),
        "fingerprints",
    )
    answers = (
        sent.where(F.col("message").isNotNull())
        .select("block", "owner", "message")
        .repartition("owner")
        .sortWithinPartitions("owner")
        .mapInArrow(tidy(_answer), "block long, owner int, answer array<long>")
    )
    bit = F.expr("shiftright(answer[cast(place div 64 as int)], place % 64) & 1")
    shared = sent.where("not copied").join(answers, ["block", "owner"]).where(bit == 1)
    return sent.where("copied").select("sha").union(shared.select("sha")).distinct()


def _sha(text: Column) -> Column:
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


def exact_dedup(
    docs: DataFrame, id: str = "doc_id", text: str = "text", carry: tuple[str, ...] | None = None, **exchange: int
) -> DataFrame:
    """Every row of ``docs`` as ``doc``, with its group of equal texts.

    Columns: ``doc`` (struct of the input columns, or of those in ``carry``), ``id``, ``sha`` (SHA-256 of the text),
    ``keep_id`` (largest id of the group), ``group_size``, ``kept``. NULL counts as an empty
    text. Of rows that share the largest id, one stays; a NULL id is below all others.
    ``exchange`` goes to ``suspect_hashes``. Runs jobs and writes scratch tables.
    """
    hashes = stored(suspect_hashes(docs, text, **exchange), "suspect_hashes")
    size = bits_for(hashes)
    bits = stored(bitmap(hashes, F.col("sha"), size), "suspects")
    rows = docs.select(
        (F.struct("*") if carry is None else F.struct(id, *carry)).alias("doc"),
        F.col(id).alias("id"),
        F.coalesce(F.col(text), F.lit("")).alias("body"),
        _sha(F.col(text)).alias("sha"),
    )
    rows = marked(rows, F.col("sha"), bits, "suspect", size)
    alone = rows.where("not suspect").select(
        "doc", "id", "sha", F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept")
    )
    held = stored(rows.where("suspect").withColumn("number", F.monotonically_increasing_id()), "held")
    rank = F.coalesce("id", F.lit(-(1 << 63)))
    groups = held.groupBy("sha", "body").agg(
        F.max("id").alias("keep_id"),
        F.max_by("number", rank).alias("keep_number"),
        F.count(F.lit(1)).alias("group_size"),
    )
    # As a table of its own it leaves the join free to split the rows of a large group.
    groups = stored(groups, "groups")
    judged = held.join(groups, ["sha", "body"]).select(
        "doc", "id", "sha", "keep_id", "group_size", (F.col("number") == F.col("keep_number")).alias("kept")
    )
    return alone.union(judged)


def deduplicated(docs: DataFrame, id: str = "doc_id", text: str = "text", **exchange: int) -> DataFrame:
    """The rows of ``docs`` that stay: of equal texts, the one with the largest id."""
    return exact_dedup(docs, id, text, **exchange).where("kept").select("doc.*")
