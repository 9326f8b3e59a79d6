"""Chat formatting from event logs.

A log says how messages came to be: a message is opened with a role, its text arrives in
deltas, may be replaced by an edit, or thrown away and streamed anew by a regeneration. The
log is dealt by message and ordered by sequence number, and a fold over the stream makes the
final texts, which are then rendered. A long conversation is spread over many tasks; a task
holds one message at a time.

Template: ``<|turn|>`` role ``<|text|>`` text ``<|end|>`` and a line feed. In roles and texts a
backslash is doubled, and one is put behind the first character of each control string, those
of the template and those of other templates, so no text can imitate a mark; dropping the
backslash before any character restores the text. The loss mask covers the escaped texts of
one role.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendscope.llm.batches import in_small_batches

#: Control strings that no text may show.
CONTROL = ("<|", "</s>", "<s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>\n"
_PIECE = re.compile(re.escape(TURN) + "(.*?)" + re.escape(TEXT) + "(.*?)" + re.escape(END), re.S)
#: Code points of a delta when a log is made from a finished conversation.
DELTA = 4096
EVENTS = "conv_id long, turn long, message long, seq long, kind string, role string, text string"


def escape(text: str) -> str:
    text = text.replace("\\", "\\\\")
    for mark in CONTROL:
        text = text.replace(mark, mark[0] + "\\" + mark[1:])
    return text


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S)


def render(role: str, text: str) -> tuple[str, int, int]:
    """A message in the template, and where its text starts and ends there."""
    head, body = TURN + escape(role) + TEXT, escape(text)
    return head + body + END, len(head), len(head) + len(body)


def parse(piece: str) -> tuple[str, str]:
    """Role and text of a rendered message."""
    role, text = _PIECE.fullmatch(piece).groups()
    return unescape(role), unescape(text)


def events_of(rows: DataFrame, delta: int = DELTA) -> DataFrame:
    """The log of finished conversations (conv_id, turn, role, text): one message per row.

    By the crc32 of ``conv_id:turn`` modulo 3 a message is streamed in deltas (0), starts with a
    draft whose text an edit replaces by the first part of the final one (1), or has a draft
    that is thrown away by a regeneration (2). Its final text is the row's in each case. Repeated
    rows are messages of their own. NULL roles and texts count as empty.
    """
    text = F.coalesce("text", F.lit(""))
    way = F.crc32(F.concat_ws(":", "conv_id", "turn").cast("binary")) % 3

    def event(kind: str, said: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), said.alias("text"))

    def part(i: Column) -> Column:
        kind = F.when((i == 0) & (way == 1), "edit").otherwise("delta")
        return F.struct(kind.alias("kind"), F.substring(text, i * delta + 1, F.lit(delta)).alias("text"))

    last = F.greatest(F.floor((F.length(text) - 1) / delta), F.lit(0)).cast("int")
    parts = F.transform(F.sequence(F.lit(0), last), part)
    empty = F.lit("")
    draft = F.concat(F.lit("draft "), F.upper(F.substring(text, 1, 20)))
    start = (
        F.when(way == 1, F.array(event("open", empty), event("delta", draft)))
        .when(way == 2, F.array(event("open", empty), event("delta", draft), event("regenerate", empty)))
        .otherwise(F.array(event("open", empty)))
    )
    numbered = in_small_batches(rows).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.monotonically_increasing_id().alias("message"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.concat(start, parts).alias("events"),
    )
    placed = numbered.select("conv_id", "turn", "message", "role", F.posexplode("events").alias("seq", "event"))
    return placed.select(
        "conv_id", "turn", "message", F.col("seq").cast("long").alias("seq"), "event.kind", "role", "event.text"
    )


_MESSAGE = "conv_id long, turn long, message long, role string, piece string, low long, high long"


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Final messages of a stream of events, sorted by message and sequence number."""
    key, role, parts = None, "", []
    names = ["conv_id", "turn", "message", "role", "piece", "low", "high"]
    types = [pa.int64()] * 3 + [pa.string()] * 2 + [pa.int64()] * 2

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    for batch in batches:
        done = []
        for *new, kind, its_role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "turn", "message", "kind", "role", "text"))):
            if new != key:
                if key is not None:
                    done.append((*key, role, *render(role, "".join(parts))))
                key, role, parts = new, its_role or "", []
            if kind in ("open", "regenerate"):
                role, parts = its_role if its_role is not None else role, []
            elif kind == "edit":
                parts = [text or ""]
            elif kind == "delta":
                parts.append(text or "")
        if done:
            yield batch_of(done)
    if key is not None:
        yield batch_of([(*key, role, *render(role, "".join(parts)))])


def messages(events: DataFrame) -> DataFrame:
    """The rendered final messages of a log.

    ``events`` has the columns of ``EVENTS``: a message is named by conversation, turn and
    message number; ``kind`` is open, delta, edit (``text`` replaces what is there) or
    regenerate (what is there goes). Other kinds change nothing. Events with one sequence
    number are taken in the order of their kind (open, then delta, edit and regenerate) and
    text. Columns: ``conv_id``, ``turn``, ``message``, ``role``, ``piece`` (the rendered
    message), ``low`` and ``high`` (code points of ``piece`` that the escaped text takes).
    """
    key = ["conv_id", "turn", "message"]
    return (
        events.select(*key, "seq", "kind", "role", "text")
        .repartition(*key)
        .sortWithinPartitions(*key, "seq", F.col("kind") != "open", "kind", "text")
        .mapInArrow(_fold, _MESSAGE)
    )


def _digest(loss_role: str):
    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = object()
        key, turns, loss, counts = none, None, None, [0, 0, 0]

        def row() -> dict:
            return {
                "conv_id": key, "n_turns": counts[0], "turns_sha256": turns.hexdigest(), "loss_chars": counts[1],
                "loss_sha256": loss.hexdigest(), "formatted_chars": counts[2],
            }

        for batch in batches:
            done = []
            for conv, piece, low, high in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "piece", "low", "high"))):
                if conv != key:
                    if key is not none:
                        done.append(row())
                    key, turns, loss, counts = conv, hashlib.sha256(), hashlib.sha256(), [0, 0, 0]
                role, text = parse(piece)
                turns.update(f"{role}\n{text}\n".encode())
                counts[0] += 1
                counts[2] += len(piece)
                if role == loss_role:
                    masked = unescape(piece[low:high])
                    loss.update(masked.encode())
                    counts[1] += len(masked)
            if done:
                yield pa.RecordBatch.from_pylist(done, _DIGEST)
        if key is not none:
            yield pa.RecordBatch.from_pylist([row()], _DIGEST)

    return digest


_DIGEST = pa.schema(
    [("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
     ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())]
)


def digests(rendered: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """One row per conversation, read back from its rendered messages by turn.

    Messages of one turn are ordered by role and (unescaped) text. Rows without a conversation id make a
    conversation of their own. A digest over a conversation needs its messages one after the
    other, so they are streamed through one task, which holds one message at a time.
    """
    # Only compared where turn and role are equal, so only then worked out.
    text = F.regexp_replace(F.substring("piece", F.col("low") + 1, F.col("high") - F.col("low")), r"(?s)\\(.)", "$1")
    return (
        rendered.select("conv_id", "turn", "role", "piece", "message", "low", "high")
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "turn", "role", text, "message")
        .mapInArrow(_digest(loss_role), "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
    )
