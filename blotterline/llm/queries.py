"""The registered queries of this folder, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blotterline.llm.bpe import code_digests
from blotterline.llm.common import read_table
from blotterline.llm.conversation_repair import damaged, normal_rows, repair
from blotterline.llm.edit_fingerprint import edited_fingerprints, similar_documents
from blotterline.llm.html_text import extract
from blotterline.llm.language_id import identify
from blotterline.llm.packing import pack_documents
from blotterline.llm.quality import fit_quality, judged
from blotterline.llm.quality_rules import fit_rules, judge
from blotterline.llm.sharding import shard_rows
from blotterline.llm.simhash import hex_digits, near_duplicates
from blotterline.llm.token_alignment import alignments
from blotterline.llm.toxicity import score_documents
from blotterline.llm.vector_search import quantised, top_k

Query = Callable[[SparkSession, str], DataFrame]


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_rows(read_table(spark, sf_dir, "documents"), shards=16)


def op2_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = quantised(read_table(spark, sf_dir, "embeddings"))
    return top_k(vectors, vectors.where(F.col("vec_id") % 50 == 0), k=5)


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return pack_documents(read_table(spark, sf_dir, "documents"), path)


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(read_table(spark, sf_dir, "documents"))
    return found.withColumn("fingerprint", hex_digits(F.col("fingerprint")))


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return code_digests(read_table(spark, sf_dir, "documents"), path)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (read_table(spark, sf_dir, name) for name in ("documents", "labels"))
    return score_documents(docs, labels)


def op7_edit_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_fingerprints(read_table(spark, sf_dir, "documents"))


def edit_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes of documents whose edit fingerprints agree in four fifths of their slots."""
    found = similar_documents(read_table(spark, sf_dir, "documents"), 0.8)
    return found.withColumn("fingerprint", F.lower(F.hex("fingerprint")))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(read_table(spark, sf_dir, "documents"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    scored = judged(docs, fit_quality(docs, read_table(spark, sf_dir, "labels")))
    return scored.select(
        "doc_id",
        "host",
        "path",
        "evidence",
        "host_posterior",
        "path_posterior",
        F.col("quality_score").alias("score"),
        (F.col("quality_score") >= 0.5).cast("int").alias("predicted"),
    )


def op10_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = extract(read_table(spark, sf_dir, "pages"))
    return found.withColumn("n_chars", F.char_length("text").cast("long"))


def op11_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    found = judge(docs.select("doc_id", "text"), fit_rules(docs, read_table(spark, sf_dir, "labels")))
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return found.select("doc_id", *counts, "base_failed", "kept")


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair(damaged(normal_rows(read_table(spark, sf_dir, "conversations"))))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, second = (public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return alignments(read_table(spark, sf_dir, "documents"), first, second)


QUERIES: dict[str, Query] = {
    "op1_sharding": op1_sharding,
    "op2_topk_search": op2_topk_search,
    "op3_packing": op3_packing,
    "op4_simhash": op4_simhash,
    "op5_bpe": op5_bpe,
    "op6_toxicity": op6_toxicity,
    "op7_edit_fingerprint": op7_edit_fingerprint,
    "op8_language_id": op8_language_id,
    "op9_quality": op9_quality,
    "op10_html": op10_html,
    "op11_quality_rules": op11_quality_rules,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_token_alignment": op13_token_alignment,
    "edit_classes": edit_classes,
}
