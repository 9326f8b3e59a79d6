"""License scans against plain Python."""

import math
import random
import re

from brute import UPPER, documents, edge_cases, sentence

from spendscope.llm import licenses, queries

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def expected(text):
    lower = (text or "").translate(UPPER)
    words = WORD.findall(lower)
    places, base = [], set()
    for phrase, label in licenses.PHRASES:
        own = phrase.split()
        for i in range(len(words) - len(own) + 1):
            if words[i : i + len(own)] == own:
                places.append(i)
                base.add(label)
    labels, score = set(base), 1.0 if base else 0.0
    for paragraph in re.split(r"\n[ \t\r]*\n", lower):
        block = set(WORD.findall(paragraph))
        for template, label in licenses.TEMPLATES:
            own = set(template.split())
            common = len(own & block)
            if common >= math.ceil(licenses.THRESHOLD * len(own) - 1e-9):
                labels.add(label)
                score = max(score, common / len(own))
    return (
        len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)), ",".join(sorted(labels)), score,
    )


def test_scan(spark):
    rng = random.Random(0)
    rows = edge_cases()
    templates = [t for t, _ in licenses.TEMPLATES]
    texts = [
        "The MIT License the mit LICENSE", "the  mit,license!the mit license", "the mit licenses", "xthe mit license", "THE\nMIT\n\nLICENSE",
        "Apache License, Version 2.0", "apache license version 20", "CC BY-NC 4.0", "cc by nc cc by nc the mit license é", "éthe mit license", "the mit license\x85",
        "This work is licensed under the GNU General Public License, version 3.", "This work is licensed under the GNU\n \nGeneral Public License",
        " ".join(["the mit license"] * 40), "İ ſ K the mit license", *templates, *(t.upper() for t in templates), "\n\n".join(templates),
    ]
    for _ in range(60):
        words = rng.choice(templates).split()
        rng.shuffle(words)
        texts.append(f"{sentence(rng, 5)}\n{' '.join(words[rng.randrange(0, 6):])} {sentence(rng, 30)}")
    rows += [(2000 + i, t) for i, t in enumerate(texts)]
    got = licenses.scan(documents(spark, rows)).collect()
    assert sorted([tuple(r) for r in got], key=repr) == sorted([(i, *expected(t)) for i, t in rows], key=repr)


def test_phrases_of_the_query(spark, tmp_path):
    rows = [
        (1, "the mit license"), (2, "Under  the\n\nMIT-License, under the mit license"), (3, "a b under the mit license 2"), (4, "under mit license"),
        (5, "Apache License, Version 2.0 under the mit licenses"), (6, "x cc by nc under the MIT license"), (7, "sunder the mit license"), (8, None),
    ]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op7_license_scan(spark, str(tmp_path)).select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels").collect()
    assert sorted(map(tuple, got)) == [
        (1, 3, 0, None, None, ""), (2, 8, 2, 0, 4, "mit"), (3, 7, 1, 2, 2, "mit"), (4, 3, 0, None, None, ""),
        (5, 9, 1, 0, 0, "apache-2"), (6, 8, 2, 1, 4, "cc-by-nc,mit"), (7, 4, 0, None, None, ""), (8, 0, 0, None, None, ""),
    ]


def test_empty(spark):
    assert licenses.scan(documents(spark, [])).count() == 0


def test_no_python(spark):
    plan = licenses.scan(documents(spark, [(1, "the mit license")]))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", plan)
