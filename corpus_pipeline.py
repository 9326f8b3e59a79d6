"""From raw documents to training sequences, in stages that are each written and read again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendscope.llm import dedup, hyperminhash, packing, substrings, toxicity
from spendscope.llm.queries import table, tokenizer_path
from spendscope.session import drop_scratch, scratch_mark, stored


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below 0.5."""
    labels = table(spark, sf_dir, "labels").where(toxicity.fold(F.col("doc_id")) != 0)
    return toxicity.toxicity(docs, labels, F.struct("*")).where("score < 0.5").select("doc.*")


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal texts, the one with the largest id."""
    return dedup.deduplicated(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by five-word shingles at a similarity of 0.8 or more, the one with the smallest id."""
    return hyperminhash.near_dedup(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages of 35 words or more that stand anywhere else as well.

    Words are kept with one space between them; a document whose words all go stays as an
    empty one.
    """
    cut = substrings.without_repeats(docs)
    text = F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("doc.text"))
    columns = {c: F.col("doc")[c] for c in docs.columns} | {"text": text}
    if "n_chars" in columns:
        columns["n_chars"] = F.coalesce(F.length(text), F.lit(0)).cast(docs.schema["n_chars"].dataType)
    return cut.select(*(value.alias(name) for name, value in columns.items()))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' tokens and their places in sequences of at most 4,096."""
    cut = packing.pieces(docs, tokenizer_path("word_bpe_49k.json"))
    return packing.packed(cut).drop("number").withColumnRenamed("id", "doc_id")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_copies),
    ("near dedup", drop_near_copies),
    ("substring dedup", cut_repeats),
    ("packing", pack),
]

#: The stages learn weights and tokenize, which SQL can't express; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's result is a table in the shared folder.

    A stage's scratch tables, and the result before it, go once its own result is written.
    """
    docs, mark = table(spark, sf_dir, "documents"), scratch_mark()
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "_"))
        drop_scratch(spark, mark, keep=1)
    return docs
