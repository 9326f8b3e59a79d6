"""Repair of conversations against the plain dynamic program and against all lists of edits."""

import hashlib
import itertools
import random
import zlib
from collections import defaultdict
from functools import lru_cache

import pytest
from pyspark.sql import types as T

from spendscope.llm import repair
from spendscope.llm.queries import op13_conversation_repair

SPACE = "\x20\x09\x0a\x0b\x0c\x0d"
NEXT = {("s", ""): "s", ("u", ""): "u", ("u", "s"): "u", ("u", "a"): "u", ("a", "u"): "a"}
GIVEN = {"": "u", "s": "u", "u": "a", "a": "u"}


def cheapest(symbols):
    """(cost, audit), least first, of symbols (initial, fault)."""

    @lru_cache(None)
    def best(i, state, puts):
        ways = []
        if i == len(symbols):
            if state in ("", "a"):
                ways.append((0, ""))
        else:
            role, fault = symbols[i]
            more = 5 if fault == "truncated" else 0
            steps = [("D", 2, state)]
            if fault not in ("blank", "duplicate"):
                if (role, state) in NEXT:
                    steps.append(("K", more, role))
                steps.append(("R", 1 + more, GIVEN[state]))
            ways += [(c + best(i + 1, to, 0)[0], e + best(i + 1, to, 0)[1]) for e, c, to in steps]
        if puts < 3:
            c, rest = best(i, GIVEN[state], puts + 1)
            ways.append((c + 5, "I" + rest))
        return min(ways, default=(10**9, ""))

    return best(0, "", 0)


def replay(audit, rows):
    """The repaired (role, text), or None if the edits don't fit."""
    state, out, at = "", [], 0
    full = {"u": "user", "a": "assistant"}
    for e in audit:
        if e == "I":
            state = GIVEN[state]
            out.append((full[state], ""))
            continue
        role, text = rows[at]
        at += 1
        if e == "K":
            if (role[:1], state) not in NEXT:
                return None
            state = role[:1]
            out.append((role, text))
        elif e == "R":
            state = GIVEN[state]
            out.append((full[state], text))
    return out if at == len(rows) and state in ("", "a") else None


def faults(rows):
    out, seen = [], set()
    for role, text in rows:
        bare = text.strip(SPACE)
        out.append("blank" if not bare else "duplicate" if (role, text) in seen else "" if bare[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def key(turn):
    return (turn is not None, turn or 0)


def expected(rows, spoil=True):
    """One tuple per conversation from rows (conv_id, turn, role, text)."""
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        own = convs[conv]
        role, text = role if role is not None else " ", text if text is not None else " "
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20 if spoil else 99
        if kind == 0:
            continue
        text = "" if kind == 1 else "".join(c for c in text if c not in ".!?") if kind == 2 else text
        own += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    out = []
    for conv, own in convs.items():
        own.sort(key=lambda r: (key(r[0]), r[1], r[2]))
        said = [(r, t) for _, r, t in own]
        turns = {t for t, _, _ in own if t is not None}
        fault = faults(said)
        pairs = [a[:1] + b[:1] for (a, _), (b, _) in zip(said, said[1:])]
        cost, audit = cheapest(tuple((r[:1], f) for (r, _), f in zip(said, fault)))
        lines = "\n".join(f"{r}:{t}" for r, t in replay(audit, said))
        out.append((conv, max(turns) - min(turns) + 1 - len(turns) if turns else 0, *(fault.count(f) for f in ("blank", "duplicate", "truncated")),
                    sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, hashlib.sha256(lines.encode()).hexdigest()))
    return sorted(out, key=repr)


COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def table(spark, rows, parts=5):
    schema = "conv_id long, turn long, role string, text string, there_ int, blank int, audit string, name long"
    full = [(*r, 1, 2, "x", 3) for r in rows]
    return spark.createDataFrame(full, T._parse_datatype_string(schema)).repartition(parts)


def run(df):
    return sorted((tuple(r) for r in df.select(COLUMNS).collect()), key=repr)


def conversations(seed, n=60, longest=14):
    rng = random.Random(seed)
    rows = []
    texts = ["One.", "Two!", "three", "", " \n", "Why? ", "One.", "end.\t", "x" * 300 + "."]
    for conv in range(n):
        for turn in range(rng.randrange(1, longest)):
            role = rng.choice(["user", "assistant", "system", "user", "assistant", "tool", "", None])
            rows.append((conv, rng.choice([turn, turn, turn * 3, None]), role, rng.choice([*texts, None, f"text {rng.random()}."])))
    return rows + [(None, 1, "user", "a."), (None, None, "assistant", "b"), (-3, 5, "user", "a."), (-3, 5, "user", "a.")]


@pytest.mark.parametrize("seed", range(3))
def test_against_plain_program(spark, seed):
    rows = conversations(seed)
    assert run(repair.repairs(repair.damage(table(spark, rows)))) == expected(rows)
    assert run(repair.repairs(table(spark, rows))) == expected(rows, spoil=False)


def test_long_runs_and_a_hot_conversation(spark):
    rows = [(1, t, "user", f"same length {t}.") for t in range(3000)]
    rows += [(1, 3000 + t, ("user", "assistant")[t % 2], f"well {t}." if t % 5 else "cut") for t in range(2000)]
    rows += [(2, t, "assistant", "again and again.") for t in range(700)] + [(3, 0, "system", "only.")]
    got = {r[0]: r for r in run(repair.repairs(table(spark, rows)))}
    symbols = repair.Powers()
    for conv in (1, 2, 3):
        own = sorted((t, r, x) for c, t, r, x in rows if c == conv)
        said = [(r, x) for _, r, x in own]
        one_by_one = [((r[:1], {"": 0, "truncated": 2}.get(f, 1)), 1) for (r, _), f in zip(said, faults(said))]
        cost, audit = repair.cheapest(one_by_one, symbols)
        assert got[conv][6:8] == (cost, audit)
        lines = "\n".join(f"{r}:{t}" for r, t in replay(audit, said))
        assert got[conv][8] == hashlib.sha256(lines.encode()).hexdigest()


def test_edits_are_cheapest_and_least():
    rng = random.Random(0)
    powers = repair.Powers()
    code = {"": repair.FINE, "blank": repair.GONE, "duplicate": repair.GONE, "truncated": repair.CUT}
    for _ in range(400):
        symbols = [(rng.choice("suax"), rng.choice(["", "", "blank", "truncated"])) for _ in range(rng.randrange(0, 9))]
        symbols = [s for s in symbols for _ in range(rng.choice((1, 1, 1, 4)))]
        runs = [((s[0] if s[0] in "sua" else "", code[s[1]]), len(list(g))) for s, g in itertools.groupby(symbols)]
        assert repair.cheapest(runs, powers) == cheapest(tuple(symbols))


def test_against_all_lists_of_edits():
    price = {"D": 2, "I": 5, "K": 0, "R": 1}
    code = {"": repair.FINE, "blank": repair.GONE, "truncated": repair.CUT}
    for symbols in itertools.product(itertools.product("sua", ["", "blank", "truncated"]), repeat=2):
        rows = [({"s": "system", "u": "user", "a": "assistant"}[r], "") for r, _ in symbols]
        ways = []
        for n in range(2, 6):
            for audit in itertools.product("DIKR", repeat=n):
                own = [e for e in audit if e != "I"]
                if len(own) != 2 or any(f == "blank" and e != "D" for e, (_, f) in zip(own, symbols)):
                    continue
                if replay(audit, rows) is not None:
                    ways.append((sum(price[e] for e in audit) + sum(5 for e, (_, f) in zip(own, symbols) if f == "truncated" and e != "D"), "".join(audit)))
        runs = [((r, code[f]), 1) for r, f in symbols]
        assert repair.cheapest(runs, repair.Powers()) == min(ways)


def test_messages(spark):
    rows = conversations(4)
    got = defaultdict(list)
    for r in repair.repaired(table(spark, rows)).collect():
        got[r.conv_id].append((r.place, r.role, r.text))
    for conv, *_, sha in expected(rows, spoil=False):
        lines = "\n".join(f"{r}:{t}" for _, r, t in sorted(got[conv]))
        assert [p for p, _, _ in sorted(got[conv])] == list(range(len(got[conv])))
        assert hashlib.sha256(lines.encode()).hexdigest() == sha


def test_query_and_nothing(spark):
    sf = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert run(op13_conversation_repair(spark, sf)) == expected(rows)
    assert repair.repairs(repair.damage(table(spark, rows, 1).limit(0))).count() == 0
