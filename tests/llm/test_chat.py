"""Chat formatting: the fold, the template, and digests against plain Python."""

import hashlib

from hypothesis import given
from hypothesis import strategies as st

from spendscope.llm import chat

PARTS = st.lists(st.sampled_from([*chat.CONTROL, "\\", "|", "<", ">", "[", "/", "s", "é", "\n", "turn|>", "text|>", "end|>\n", " "]))


@given(PARTS.map("".join), PARTS.map("".join))
def test_render_and_parse(role, text):
    piece, low, high = chat.render(role, text)
    assert chat.parse(piece) == (role, text)
    assert chat.unescape(piece[low:high]) == text
    assert piece.count(chat.TURN) == piece.count(chat.TEXT) == piece.count("<|end|>") == 1
    assert not any(mark in piece[low:high] for mark in chat.CONTROL)


def log(spark, rows):
    return spark.createDataFrame(rows, chat.EVENTS)


def test_fold(spark):
    rows = [
        (1, 0, 0, 0, "open", "user", None), (1, 0, 0, 1, "delta", None, "hel"), (1, 0, 0, 2, "delta", None, "lo"),
        (1, 1, 0, 3, "open", "assistant", None), (1, 1, 0, 4, "delta", None, "bad"), (1, 1, 0, 5, "regenerate", None, None),
        (1, 1, 0, 6, "delta", None, "go"), (1, 1, 0, 8, "delta", None, "d"), (1, 1, 0, 7, "delta", None, "o"),
        (1, 0, 0, 9, "edit", None, "bye"), (1, 0, 0, 10, "delta", None, "!"), (1, 2, 0, 11, "open", "user", None),
        (2, 0, 0, 0, "open", None, None), (2, 0, 0, 1, "note", None, "nothing"), (2, 0, 0, 2, "edit", None, None),
        (None, None, None, None, "open", "user", None), (None, None, None, 1, "delta", None, "x"),
    ]
    found = {(r.conv_id, r.turn): chat.parse(r.piece) for r in chat.messages(log(spark, rows[::-1]).repartition(4)).collect()}
    assert found == {
        (1, 0): ("user", "bye!"), (1, 1): ("assistant", "good"), (1, 2): ("user", ""), (2, 0): ("", ""), (None, None): ("user", "x"),
    }


def test_a_long_text_in_many_deltas(spark):
    text = "é\\[INST] " * 5000
    rows = spark.createDataFrame([(1, 0, "assistant", text)], "conv_id long, turn long, role string, text string")
    events = chat.events_of(rows, delta=700)
    assert -(-len(text) // 700) < events.count() <= 3 + -(-len(text) // 700)
    (row,) = chat.digests(chat.messages(events)).collect()
    assert (row.loss_chars, row.loss_sha256) == (len(text), hashlib.sha256(text.encode()).hexdigest())


def test_ways_of_a_log(spark):
    """Logs made from rows hold edits and regenerations, and fold back to the rows."""
    rows = [(c, t, "user", f"text {c} {t} " * (t + 1) if t else "") for c in range(40) for t in range(3)] + [(None, None, None, None)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    events = chat.events_of(df, delta=16)
    kinds = {r["kind"]: r["count"] for r in events.groupBy("kind").count().collect()}
    assert kinds["open"] == len(rows) and kinds["edit"] > 20 and kinds["regenerate"] > 20 and kinds["delta"] > len(rows)
    found = sorted((r.conv_id, r.turn, *chat.parse(r.piece)) for r in chat.messages(events.repartition(3)).collect() if r.conv_id is not None)
    assert found == sorted(rows[:-1])


def test_order_within_a_turn(spark):
    """Messages of one turn and role stand in the order of their texts, not of the escaped ones."""
    groups = {1: ["a", "a b"], 2: ["<|x", "<a"], 3: ["\\", "]", "[INST]", "[", "</s>", "<0"], 4: ["é", "e", ""]}
    rows = [(c, 0, "user", t) for c, own in groups.items() for t in own]
    df = spark.createDataFrame(rows[::-1], "conv_id long, turn long, role string, text string")
    for r in chat.digests(chat.messages(chat.events_of(df.repartition(4)))).collect():
        lines = "".join(f"user\n{t}\n" for t in sorted(groups[r.conv_id]))
        assert r.turns_sha256 == hashlib.sha256(lines.encode()).hexdigest()


def test_digests(spark):
    rows = [(c, t, r, x, "extra") for c in (1, 2, None) for t in (0, 1, 1, 2, None) for r, x in (("user", "q</s>"), ("assistant", "é" * t if t else None))]
    rows += [(3, 0, None, None, "extra"), (4, 0, "assistant", "same", None), (4, 0, "assistant", "same", None)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, message string")
    got = {r.conv_id: r for r in chat.digests(chat.messages(chat.events_of(df.repartition(5)))).collect()}
    assert set(got) == {1, 2, 3, 4, None}
    for conv, row in got.items():
        own = [(-1 if t is None else t, r or "", x or "") for c, t, r, x, _ in rows if c == conv]
        own = [(r, x) for _, r, x in sorted(own)]
        loss = "".join(x for r, x in own if r == "assistant")
        assert row.n_turns == len(own)
        assert row.turns_sha256 == hashlib.sha256("".join(f"{r}\n{x}\n" for r, x in own).encode()).hexdigest()
        assert (row.loss_chars, row.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
        assert row.formatted_chars == sum(len(chat.render(r, x)[0]) for r, x in own)


def test_empty(spark):
    assert chat.digests(chat.messages(chat.events_of(spark.createDataFrame([], "conv_id long, turn long, role string, text string")))).count() == 0
