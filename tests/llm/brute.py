"""Plain Python versions of the operators, and tables full of edge cases."""

import hashlib
import random
import re
from collections import Counter, defaultdict

from pyspark.sql import types as T

WORD = re.compile(r"[^\x20\x09-\x0D]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
#: Extra columns whose names the operators use for their own.
CLASHING = ("id", "doc", "number", "source", "body", "words", "sha", "kept", "score", "n_words", "member", "spans", "start", "length", "block")
DOCS = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())]
    + [T.StructField(c, T.StringType()) for c in CLASHING]
)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def documents(spark, rows, parts=3):
    """Rows (doc_id, text) with extra columns, over some partitions."""
    full = [(i, t, *(f"{c} {n}" for c in CLASHING)) for n, (i, t) in enumerate(rows)]
    return spark.createDataFrame(full, DOCS).repartition(parts) if full else spark.createDataFrame([], DOCS)


def sentence(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def edge_cases(seed=0):
    """Copies, near copies, chains, shared passages, NULLs, blanks, repeated rows, a long text."""
    rng = random.Random(seed)
    base = [sentence(rng, rng.randrange(30, 120)) for _ in range(12)]
    rows = [(100 + i, t) for i, t in enumerate(base)]
    rows += [(200 + i, base[0]) for i in range(25)]
    for i in range(30):  # near copies of one text, and of each other
        words = base[1].split()
        for _ in range(rng.randrange(1, 4)):
            words[rng.randrange(len(words))] = f"x{rng.randrange(1000)}"
        rows.append((300 + i, " ".join(words)))
    chain = sentence(rng, 100).split()  # each like the next one, the ends unlike
    for i in range(8):
        rows.append((400 + i, " ".join(chain)))
        chain = chain[3:] + sentence(rng, 3).split()
    passage = sentence(rng, 60)
    rows += [(500 + i, f"{sentence(rng, rng.randrange(0, 80))}\n{passage}\t{sentence(rng, rng.randrange(0, 80))}") for i in range(12)]
    rows += [(600, None), (601, ""), (602, " \n\t "), (603, "one"), (604, "one"), (605, "One two three"), (606, "one two  three")]
    rows += [(None, "one two three four five six"), (None, None), (607, "a " * 50), (608, "ab ab é É " * 30)]
    rows += [(609, base[2]), (609, base[2]), (609, base[3]), (610, sentence(rng, 20_000)), (611, "x" * 5000), (-5, base[4].upper())]
    rng.shuffle(rows)
    return rows


def shingles(text, width):
    words = WORD.findall((text or "").translate(UPPER))
    if not words:
        return frozenset()
    if len(words) < width:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[i : i + width]) for i in range(len(words) - width + 1))


def components(texts, width, percent):
    """For each text the number of its component."""
    sets = [shingles(t, width) for t in texts]
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    holders = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            holders[x].append(i)
    common = Counter((a, b) for own in holders.values() for k, a in enumerate(own) for b in own[k + 1 :])
    for (a, b), n in common.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            root[find(b)] = find(a)
    return [find(i) for i in range(len(texts))], sets


def without_repeats(texts, width):
    """The kept words of each text."""
    words = [WORD.findall(t or "") for t in texts]
    seen = Counter(tuple(w[i : i + width]) for w in words for i in range(len(w) - width + 1))
    kept = []
    for w in words:
        gone = set()
        for i in range(len(w) - width + 1):
            if seen[tuple(w[i : i + width])] > 1:
                gone.update(range(i, i + width))
        kept.append([x for i, x in enumerate(w) if i not in gone])
    return words, kept
