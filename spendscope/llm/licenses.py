"""License scans: an exact set-similarity join of text blocks with license templates.

Only DataFrame functions are used. A block is a paragraph; its set holds the distinct words
that occur in any template, the others can match nothing. A block matches a template if it
holds at least the share ``threshold`` of the template's distinct words. Words are ordered by
their global frequency, rarest first. If a block shares ``o`` words with a template of ``t``
words, the first ``t - o + 1`` words of the template and the first ``b - o + 1`` of the block
have one in common, so only these prefixes are joined. Length and position of the common word
rule out most of what is left; the rest is verified on the whole sets.

Phrases (the base) are found by place in the words of the whole text.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendscope.session import stored

#: Phrases and their labels.
PHRASES = (("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc"))

#: Sentences of well-known license notices and their labels.
TEMPLATES = (
    ("permission is hereby granted free of charge to any person obtaining a copy of this software", "mit"),
    ("licensed under the apache license you may not use this file except in compliance with the license", "apache-2"),
    ("this work is licensed under the gnu general public license", "gpl"),
    ("this program is free software you can redistribute it and or modify it under the terms of the gnu general public license", "gpl"),
    ("redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", "bsd"),
    ("this work is licensed under a creative commons attribution license", "cc-by"),
    ("this source code form is subject to the terms of the mozilla public license", "mpl"),
)
THRESHOLD = 0.8

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_MARKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _words(text: Column) -> Column:
    """Words of lower-case text with one space between them."""
    return F.trim(F.regexp_replace(text, _MARKS, " "))


def _spaces(text: Column) -> Column:
    return (F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))).cast("long")


def _base(line: Column, n_words: Column, phrases: Sequence[tuple[str, str]]) -> list[Column]:
    """Places of the phrases in ``line``, where each word has a space of its own on both sides."""
    counts, firsts, lasts, labels = [], [], [], []
    for phrase, label in phrases:
        wide = " " + phrase.replace(" ", "  ") + " "
        has = line.contains(wide)
        gone = F.length(F.replace(line, F.lit(wide), F.lit("")))
        counts.append(F.when(has, ((F.length(line) - gone) / len(wide)).cast("long")).otherwise(0))
        firsts.append(F.when(has, F.floor(_spaces(F.substring_index(line, wide, 1)) / 2).cast("long")))
        after = F.floor(_spaces(F.substring_index(line, wide, -1)) / 2).cast("long")
        lasts.append(F.when(has, n_words - after - len(phrase.split())))
        labels.append(F.when(has, F.lit(label)))
    least = F.array_min(F.array(*firsts))
    most = F.array_max(F.array(*lasts))
    found = F.array_sort(F.array_distinct(F.array_compact(F.array(*labels))))
    return [
        sum(counts[1:], counts[0]).cast("long").alias("n_base"), least.alias("first_word"), most.alias("last_word"), found.alias("base"),
    ]


def scan(
    docs: DataFrame, id: str = "doc_id", text: str = "text", phrases: Sequence[tuple[str, str]] = PHRASES,
    templates: Sequence[tuple[str, str]] = TEMPLATES, threshold: float = THRESHOLD,
) -> DataFrame:
    """One row per row of ``docs`` with its license labels.

    Columns: ``id``, ``n_words``, ``n_base`` (places of phrases), ``first_word``, ``last_word``
    (their smallest and largest start, or NULL), ``base_labels``, ``labels`` (those of matching
    templates, too; sorted, joined by commas), ``score`` (1 for a phrase, else the largest share
    of a matching template's words, else 0). NULL counts as empty. Templates are a list that
    the driver holds, so their words may be broadcast. Writes a table of the blocks' sets.
    """
    spark = docs.sparkSession
    sets = [sorted(set(t.split())) for t, _ in templates]
    needed = [math.ceil(threshold * len(s) - 1e-9) for s in sets]
    vocabulary = sorted({w for s in sets for w in s})
    least = min(needed, default=1)

    lower = F.translate(F.coalesce(F.col(text), F.lit("")), _UPPER, _LOWER)
    paragraphs = F.filter(F.transform(F.split(lower, r"\n[ \t\r]*\n"), _words), lambda p: p != "")
    rows = docs.select(F.col(id).alias("id"), paragraphs.alias("paragraphs"))
    line = F.replace(F.concat(F.lit(" "), F.array_join("paragraphs", " "), F.lit(" ")), F.lit(" "), F.lit("  "))
    # "  a  b  ": cut to one space at either end; without words nothing is left.
    line = F.when(F.size("paragraphs") > 0, line.substr(F.lit(2), F.length(line) - 2)).otherwise("")
    rows = rows.select("id", "paragraphs", line.alias("line"))
    n_words = F.floor(_spaces(F.col("line")) / 2).cast("long")
    known = F.array(*(F.lit(w) for w in vocabulary))
    blocks = F.filter(
        F.transform("paragraphs", lambda p: F.array_intersect(known, F.split(p, " "))), lambda b: F.size(b) >= least
    )
    rows = rows.select(
        F.monotonically_increasing_id().alias("number"), "id", n_words.alias("n_words"), *_base(F.col("line"), n_words, phrases), blocks.alias("blocks")
    )
    rows = stored(rows, "blocks")

    # One row for each word of the templates.
    counts = rows.select(F.explode(F.flatten("blocks")).alias("word")).groupBy("word").count()
    frequency = {r["word"]: r["count"] for r in counts.collect()}
    order = sorted(vocabulary, key=lambda w: (frequency.get(w, 0), w))
    rank = {w: i for i, w in enumerate(order)}
    index, whole = [], []
    for no, (own, (_, label), o) in enumerate(zip(sets, templates, needed)):
        own = sorted(own, key=rank.__getitem__)
        whole.append((no, label, own))
        index += [(w, no, i, len(own), o) for i, w in enumerate(own[: len(own) - o + 1])]
    index = spark.createDataFrame(index, "word string, template int, place int, size int, needed int")
    whole = spark.createDataFrame(whole, "template int, label string, words array<string>")

    ordered = F.array(*(F.lit(w) for w in order))
    block = rows.select("number", F.posexplode("blocks").alias("block", "own")).withColumn("own", F.array_intersect(ordered, "own"))
    prefix = block.withColumn("b", F.size("own")).select(
        "number", "block", "own", "b", F.posexplode(F.slice("own", F.lit(1), F.col("b") - (least - 1))).alias("at", "word")
    )
    rest = F.least(F.col("size") - F.col("place"), F.col("b") - F.col("at"))
    candidates = (
        prefix.join(F.broadcast(index), "word")
        .where((F.col("b") >= F.col("needed")) & (F.col("at") <= F.col("b") - F.col("needed")) & (rest >= F.col("needed")))
        .join(F.broadcast(whole), "template")
    )
    common = F.size(F.array_intersect("own", "words"))
    matched = (
        candidates.withColumn("common", common)
        .where(F.col("common") >= F.col("needed"))
        .groupBy("number")
        .agg(F.collect_set("label").alias("more"), F.max(F.col("common") / F.col("size")).alias("share"))
    )
    labels = F.array_sort(F.array_union("base", F.coalesce("more", F.expr("cast(array() as array<string>)"))))
    share = F.when(F.size("base") > 0, F.lit(1.0)).otherwise(F.coalesce("share", F.lit(0.0)))
    return rows.join(matched, "number", "left").select(
        "id", "n_words", "n_base", "first_word", "last_word",
        F.array_join("base", ",").alias("base_labels"), F.array_join(labels, ",").alias("labels"), share.alias("score"),
    )
