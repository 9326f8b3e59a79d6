"""The queries of this subpackage: each applies an operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendscope.llm import chat, dedup, hyperminhash, licenses, nbest, packing, repair, substrings, suffixes, topk, toxicity, urls, whitening


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str) -> str:
    """Place of a public tokenizer's file, the same on all machines."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    text = "</s>[INST] ok [/INST]"
    added = spark.createDataFrame([(-7, 0, "user", text), (-7, 1, "assistant", text)], "conv_id long, turn long, role string, text string")
    return chat.digests(chat.messages(chat.events_of(rows.unionByName(added))))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup.exact_dedup(docs, carry=()).select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.lower(F.hex("sha")).alias("text_sha256")
    )


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages"), urls.RULES, urls.TOPICS)


def op4_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = packing.pieces(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))
    return packing.packed(cut).select(
        F.col("id").alias("doc_id"), "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"
    )


def op6_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = hyperminhash.near_groups(table(spark, sf_dir, "documents"), width=4, percent=80)
    kept = F.col("id").eqNullSafe(F.col("component_id"))
    return groups.select(F.col("id").alias("doc_id"), "n_shingles", "component_id", kept.alias("kept"))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op8_nbest_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = nbest.n_best(table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))
    return found.withColumnRenamed("id", "doc_id")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    taught = labels.where(toxicity.fold(F.col("doc_id")) != 0)
    scored = toxicity.toxicity(docs, taught, F.col("doc_id"))
    return scored.select(
        F.col("doc").alias("doc_id"),
        (toxicity.fold(F.col("doc")) == 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return substrings.without_repeats(docs, carry=("doc_id",)).select(
        "doc.doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256")
    )


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings")).withColumnRenamed("id", "vec_id")


def op12_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    cut = suffixes.without_earlier(docs, carry=("doc_id",), with_text=False)
    return cut.select("doc.doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return repair.repairs(repair.damage(rows))


REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_chat_format, op2_exact_dedup, op3_url_filter, op4_topk_search, op5_packing, op6_near_dedup,
        op7_license_scan, op8_nbest_pieces, op9_toxicity, op10_substring_dedup, op11_embedding_whitening,
        op12_suffix_dedup, op13_conversation_repair,
    )
}
