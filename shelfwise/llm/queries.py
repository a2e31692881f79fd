"""The registered document queries: thin digests of the operators' results."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm import (
    conversations,
    fertility,
    jaccard,
    language_model,
    packing,
    phrases,
    pii,
    quality,
    secrets,
    shards,
    tokens,
    vector_codes,
    vectors,
)
from shelfwise.llm.common import table

PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")
WORD_MODEL = public_tokenizers.path("word_bpe_49k.json")


def op1_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups: 3-word shingles, Jaccard 0.9 or more."""
    return jaccard.jaccard_components(table(spark, sf_dir, "documents"), size=3, percent=90)


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of every whole text."""
    return tokens.token_counts(table(spark, sf_dir, "documents"), PIECE_MODEL)


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark passages in the documents."""
    return phrases.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_uniform_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """24 shards whose row counts are at most one apart, uniformly shuffled."""
    text = F.coalesce("text", F.lit("")).cast("binary")
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    return shards.uniform_shards(docs, 24).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates of every document and the forest's judgement."""
    return secrets.scan(table(spark, sf_dir, "documents"))


def op6_bin_slack_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 4096 tokens."""
    return packing.pack_documents(table(spark, sf_dir, "documents"), WORD_MODEL)


def op7_itq_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate embeddings of one label: cosine 0.98 or more."""
    return vectors.near_vectors(table(spark, sf_dir, "embeddings"))


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data and the terms that disclose it."""
    return pii.find_pii(table(spark, sf_dir, "documents")).drop("tid")


def op9_elias_fano_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log10 probabilities of all documents under the trie model."""
    return language_model.score_documents(table(spark, sf_dir, "documents"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality scores learnt from the labels."""
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Damaged conversations, their faults and their cheapest repair."""
    return conversations.audit(conversations.damage(table(spark, sf_dir, "conversations")),
                               table(spark, sf_dir, "conversations"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings as 16 codes of one byte each, and what they lose."""
    return vector_codes.compressed_codes(table(spark, sf_dir, "embeddings"))


def op13_tokeniser_fertility(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base rules and fertility bands of every whole text."""
    return fertility.apply_rules(table(spark, sf_dir, "documents"), PIECE_MODEL)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_ngram_jaccard, op2_token_counts, op3_decontamination, op4_uniform_shards,
                            op5_secret_scan, op6_bin_slack_packing, op7_itq_near_vectors, op8_pii,
                            op9_elias_fano_lm, op10_quality, op11_conversation_repair, op12_vector_codes,
                            op13_tokeniser_fertility)}
ORACLE: dict[str, str] = {}
