"""Repairing the structure of conversations by run-length dynamic programming.

A repaired conversation's roles read ``(s?(ua)+)?`` by their initials: perhaps a system message,
then user and assistant in turn. Four states follow that: nothing yet, after s, after u, after a.
From each of them exactly one role can be given or put in, so a list of edits settles the roles.

A message is a symbol of its role and fault. Equal neighbours are one run, and a symbol's costs
from state to state make a min-plus matrix, whose powers of two are kept. From the end, the
costs still to come are carried over each run with a few of these powers. Then the edits are
unrolled from the start: each is the ASCII-least one that keeps the cost; a long run is halved
with the same powers until its messages stand alone.

The messages of a conversation are ordered within the stream of one task. A first stream reads
roles and faults and yields the edits, a second one gets a conversation's edits ahead of its
messages and holds one batch of these. So a task holds a byte or two per message of a
conversation (the list of edits, which is a result) and 32 bytes per run, but not its texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendscope.llm.batches import in_small_batches
from spendscope.operators.joins import attach
from spendscope.session import stored

BLANK = " \t\n\x0b\x0c\r"
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
STATES, NEVER = 4, 1 << 60
#: The role that can be given or put in, and the state behind it, for each state.
GIVEN = ("user", "user", "assistant", "user")
AFTER = (2, 2, 3, 2)
#: Where a kept role leads.
KEPT = {("s", 0): 1, ("u", 0): 2, ("u", 1): 2, ("u", 3): 2, ("a", 2): 3}
FINE, GONE, CUT = range(3)
ENDS = (0, NEVER, NEVER, 0)
LEGAL = {"su", "ua", "au"}

Symbol = tuple[str, int]
Vector = tuple[int, ...]


def _with_inserts(rest: Vector) -> Vector:
    """Costs when messages may be put in first. Two are the most that ever help."""
    for _ in range(2):
        rest = tuple(min(rest[q], INSERT + rest[AFTER[q]]) for q in range(STATES))
    return rest


def _options(symbol: Symbol, state: int) -> Iterator[tuple[str, int, int]]:
    """Edits of a message in ASCII order: initial, cost, state behind it."""
    role, fault = symbol
    yield "D", DELETE, state
    if fault != GONE:
        more = TRUNCATED if fault == CUT else 0
        if (role, state) in KEPT:
            yield "K", KEEP + more, KEPT[role, state]
        yield "R", REROLE + more, AFTER[state]


class Powers:
    """Min-plus matrices of symbols, and their powers of two as far as they were needed."""

    def __init__(self) -> None:
        self.known: dict[Symbol, list[np.ndarray]] = {}

    def power(self, symbol: Symbol, k: int) -> np.ndarray:
        powers = self.known.get(symbol)
        if powers is None:
            step = np.full((STATES, STATES), NEVER)
            for q in range(STATES):
                for _, cost, to in _options(symbol, q):
                    step[q, to] = min(step[q, to], cost)
            before = np.array([_with_inserts(tuple(step[:, to].tolist())) for to in range(STATES)]).T
            powers = self.known[symbol] = [before]
        while len(powers) <= k:
            last = powers[-1]
            powers.append(np.minimum((last[:, :, None] + last[None, :, :]).min(axis=1), NEVER))
        return powers[k]

    def before(self, symbol: Symbol, n: int, rest: Vector) -> Vector:
        """The costs still to come ahead of ``n`` equal messages, from those behind them."""
        k = 0
        while n:
            if n & 1:
                m = self.power(symbol, k)
                rest = tuple(np.minimum((m + np.array(rest)).min(axis=1), NEVER).tolist())
            n, k = n >> 1, k + 1
        return rest

    def unroll(self, symbol: Symbol, n: int, state: int, rest: Vector, out: list[str]) -> int:
        """Appends the edits of ``n`` equal messages and returns the state behind them."""
        open_parts = [(n, rest)]
        while open_parts:
            n, rest = open_parts.pop()
            if n > 1:
                half = 1 << ((n - 1).bit_length() - 1)
                open_parts.append((half, rest))
                open_parts.append((n - half, self.before(symbol, half, rest)))
                continue
            ahead = self.before(symbol, 1, rest)
            while True:
                options = list(_options(symbol, state))
                options.append(("I", INSERT, AFTER[state]))
                for edit, cost, to in sorted(options):
                    if cost + (ahead if edit == "I" else rest)[to] == ahead[state]:
                        break
                out.append(edit)
                state = to
                if edit != "I":
                    break
        return state


def cheapest(runs: list[tuple[Symbol, int]], powers: Powers) -> tuple[int, str]:
    """The least cost of a conversation and the ASCII-least of its cheapest lists of edits."""
    end = _with_inserts(ENDS)
    costs = np.empty((len(runs) + 1, STATES), np.int64)
    costs[-1] = rest = end
    for i in range(len(runs) - 1, -1, -1):
        costs[i] = rest = powers.before(*runs[i], rest)
    state, out = 0, []
    for (symbol, n), rest in zip(runs, costs[1:]):
        state = powers.unroll(symbol, n, state, tuple(rest.tolist()), out)
    while end[state] and state:
        out.append("I")
        state = AFTER[state]
    return int(costs[0][0]), "".join(out)


_COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal")
_EDITS = "conv_id long, " + ", ".join(f"{c} long" for c in _COUNTS) + ", cost long, audit string"


class _Conversation:
    def __init__(self) -> None:
        self.counts = dict.fromkeys(_COUNTS, 0)
        self.runs: list[tuple[Symbol, int]] = []
        self.first = self.last = self.before = None
        self.turns = 0

    def add(self, turn: int | None, role: str, text_key: tuple, blank: bool, repeated: bool, cut: bool) -> None:
        initial = role[:1]
        if self.before is not None:
            self.counts["illegal"] += self.before[1][:1] + initial not in LEGAL
        if turn is not None:
            if self.turns == 0:
                self.first = turn
            self.turns += self.turns == 0 or turn != self.last
            self.last = turn
        row = (turn, role, text_key)
        name = "blank" if blank else "duplicate" if repeated or row == self.before else "truncated" if cut else None
        self.before = row
        if name:
            self.counts[name] += 1
        fault = {"blank": GONE, "duplicate": GONE, "truncated": CUT, None: FINE}[name]
        symbol = (initial if initial in "sua" else "", fault)
        if self.runs and self.runs[-1][0] == symbol:
            self.runs[-1] = (symbol, self.runs[-1][1] + 1)
        else:
            self.runs.append((symbol, 1))

    def result(self, powers: Powers) -> tuple:
        if self.turns:
            self.counts["gaps"] = self.last - self.first + 1 - self.turns
        return (*(self.counts[c] for c in _COUNTS), *cheapest(self.runs, powers))


_NO_KEY = object()


def _find_edits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per conversation, from its rows in order."""
    powers, key, held = Powers(), _NO_KEY, _Conversation()
    names = ["conv_id", *_COUNTS, "cost", "audit"]
    types = [pa.int64()] * 7 + [pa.string()]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    columns = ("conv_id", "there", "turn", "role", "name", "name2", "blank", "repeated", "cut")
    for batch in batches:
        done = []
        for conv, there, turn, role, name, name2, *faults in zip(*(batch.column(c).to_pylist() for c in columns)):
            if conv != key:
                if key is not _NO_KEY:
                    done.append((key, *held.result(powers)))
                key, held = conv, _Conversation()
            if there:
                held.add(turn, role, (name, name2), *faults)
        if done:
            yield batch_of(done)
    if key is not _NO_KEY:
        yield batch_of([(key, *held.result(powers))])


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Events of a sorted stream: (edits' row, None, None) ahead of a conversation, then (None, role, text) of
    its repaired messages."""
    audit, at, state = "", 0, 0

    def inserted() -> Iterator[tuple]:
        nonlocal at, state
        while at < len(audit) and audit[at] == "I":
            yield None, GIVEN[state], ""
            at, state = at + 1, AFTER[state]

    for batch in batches:
        for row in batch.to_pylist():
            if row["audit"] is not None:
                yield from inserted()
                audit, at, state = row["audit"], 0, 0
                yield row, None, None
                continue
            yield from inserted()
            edit, at = audit[at], at + 1
            if edit == "K":
                state = KEPT[row["role"][:1], state]
                yield None, row["role"], row["text"]
            elif edit == "R":
                yield None, GIVEN[state], row["text"]
                state = AFTER[state]
    yield from inserted()


def _rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("conv_id", pa.int64()), ("place", pa.int64()), ("role", pa.string()), ("text", pa.string())])
    conv, place, done, size = None, 0, [], 0
    for edits, role, text in _apply(batches):
        if edits is not None:
            conv, place = edits["conv_id"], 0
            continue
        done.append((conv, place, role, text))
        place, size = place + 1, size + len(text)
        if len(done) == 1000 or size > 1 << 20:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), schema.types)], schema=schema)
            done, size = [], 0
    if done:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), schema.types)], schema=schema)


def _digests_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["conv_id", *_COUNTS, "cost", "audit"]
    schema = pa.schema([*((n, pa.int64()) for n in names[:-1]), ("audit", pa.string()), ("repaired_sha256", pa.string())])
    held, digest, some, done = None, hashlib.sha256(), False, []
    for edits, role, text in _apply(batches):
        if edits is not None:
            if held is not None:
                done.append({n: held[n] for n in names} | {"repaired_sha256": digest.hexdigest()})
            held, digest, some = edits, hashlib.sha256(), False
            if len(done) == 1000:
                yield pa.RecordBatch.from_pylist(done, schema)
                done = []
            continue
        digest.update(f"{chr(10) if some else ''}{role}:{text}".encode())
        some = True
    if held is not None:
        done.append({n: held[n] for n in names} | {"repaired_sha256": digest.hexdigest()})
    if done:
        yield pa.RecordBatch.from_pylist(done, schema)


def damage(rows: DataFrame, kinds: int = 20) -> DataFrame:
    """Conversations (conv_id, turn, role, text) spoilt by the crc32 of ``conv_id:turn`` modulo ``kinds``.

    0 drops a row (it stays with ``there`` False, so its conversation isn't forgotten), 1 empties
    its text, 2 removes ``.!?`` from it, 3 repeats it, 4 makes its role user. NULL counts as one
    space, but stays NULL in ``conv_id`` and ``turn``.
    """
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    kind = F.crc32(key.cast("binary")) % kinds
    text = F.coalesce("text", space)
    return rows.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.when(kind == 4, "user").otherwise(F.coalesce("role", space)).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        (kind != 0).alias("there"),
        F.explode(F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    ).drop("copy")


def _trimmed(text: Column) -> Column:
    return F.rtrim(text, F.lit(BLANK))


_ORDER = ("turn", "role", "text")
_TEXT = ("role", "name", "name2")


def _prepared(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The messages, and a row with the edits for each conversation."""
    text = F.coalesce("text", F.lit(" "))
    there = F.col("there") if "there" in rows.columns else F.lit(True)
    full = in_small_batches(rows).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"),
        text.alias("text"),
        there.alias("there"),
        F.xxhash64(text).alias("name"),
        F.xxhash64(F.lit(1), text).alias("name2"),
        (_trimmed(text) == "").alias("blank"),
        (~F.right(_trimmed(text), F.lit(1)).isin(".", "!", "?")).alias("cut"),
    )
    key = ["conv_id", *_TEXT]
    # Texts said more than once, with the first turn; a copy within one turn is seen in the stream.
    often = full.where("there and not blank").groupBy(*key).agg(F.min(F.struct("turn")).alias("first"), F.count(F.lit(1)).alias("said"))
    often = stored(often.where("said > 1").select(*key, F.col("first.turn").alias("first_turn"), F.lit(True).alias("often")), "said_often")
    marked = attach(full, often, key)
    repeated = F.coalesce(F.col("often"), F.lit(False)) & ~F.col("turn").eqNullSafe(F.col("first_turn"))
    sorted_rows = marked.withColumn("repeated", repeated).drop("often", "first_turn").repartition("conv_id").sortWithinPartitions("conv_id", *_ORDER)
    return full.where("there"), stored(sorted_rows.mapInArrow(_find_edits, _EDITS), "edits")


def _stream(rows: DataFrame) -> DataFrame:
    messages, edits = _prepared(rows)
    both = edits.withColumn("is_row", F.lit(False)).unionByName(
        messages.select("conv_id", *_ORDER, F.lit(True).alias("is_row")), allowMissingColumns=True
    )
    return both.repartition("conv_id").sortWithinPartitions("conv_id", "is_row", *_ORDER)


def repaired(rows: DataFrame) -> DataFrame:
    """The messages of the repaired conversations: ``conv_id``, ``place`` (from 0), ``role``, ``text``."""
    return _stream(rows).mapInArrow(_rows_of, "conv_id long, place long, role string, text string")


def repairs(rows: DataFrame) -> DataFrame:
    """How each conversation of ``rows`` (conv_id, turn, role, text) is repaired.

    Messages are taken by turn, NULL first, then by role and text. A NULL role or text counts as
    one space, NULL conversation ids make one conversation; a row whose ``there`` (if there is
    such a column) is False only names its conversation. A message's first fault counts: blank,
    duplicate (role and text were there before) or truncated (doesn't end in ``.!?``).

    Columns: ``conv_id``; ``gaps`` (turns missing between the first and the last), ``blank``,
    ``duplicate``, ``truncated``, ``illegal`` (neighbours whose roles may not follow each other),
    ``cost``, ``audit`` (Delete, Insert, Keep, Rerole by initials), ``repaired_sha256`` (of the
    lines ``role:text``). A conversation without messages has zeros and empty values.
    """
    names = ["conv_id", *_COUNTS, "cost"]
    return _stream(rows).mapInArrow(_digests_of, ", ".join(f"{n} long" for n in names) + ", audit string, repaired_sha256 string")
