"""Corpus pipeline: quality, near-duplicates, contamination, personal data, packing.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept
and returns a DataFrame; all but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm import jaccard, packing, phrases, pii, quality
from shelfwise.llm.common import bound_batches, bounded_broadcast, stage, table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """``docs`` but for the ids given; rows that share an id stay or go together,
    rows with a null id stay."""
    gone = stage(ids.select("doc_id").where("doc_id is not null").distinct(), "gone")
    return docs.join(bounded_broadcast(gone), "doc_id", "left_anti").select(*docs.columns)


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts.

    A text's score alone decides: null, empty and very long texts are scored like
    others, equal texts and repeated rows stay or go together, rows without an id
    stay if their text does.  Without usable labels every score is one half and
    all stay; an empty table stays empty."""
    model = quality.learn(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs, model, keep=docs.columns).where("predicted = 1").select(*docs.columns)


def keep_first(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the smallest id, of each near-duplicate group
    (5-word shingles, Jaccard 0.8 or more).  Null, empty and blank texts are in no
    group and stay; rows that repeat the smallest id stay together."""
    bound_batches(spark)
    return _without(docs, jaccard.jaccard_components(docs).where("doc_id <> component_id"))


def keep_uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth are benchmark passages.  Texts
    without words are never contaminated; without benchmark texts all stay."""
    found = phrases.decontaminate(docs, table(spark, sf_dir, "benchmark"))
    return _without(docs, found.where("contaminated"))


def generalise_personal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data and the terms that disclose it generalised;
    n_chars counts the new text.  Null and empty texts stay as they are."""
    bound_batches(spark)
    clean = pii.sanitise(docs, pii.find_pii(docs))
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) \
        if "n_chars" in docs.columns else clean


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents in sequences of at most 4096 tokens.  Null and
    empty texts are one piece of the end token alone; repeated rows and rows
    without an id are packed each; an empty table has no pieces."""
    bound_batches(spark)
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("quality classifier", keep_good), ("n-gram Jaccard join", keep_first),
          ("benchmark decontamination", keep_uncontaminated), ("PII", generalise_personal),
          ("best-fit packing", pack)]

# The classifier, the tokenizer and the packing have no SQL; tests/llm checks run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again.  Other
    columns than those of documents are left out; each stage says what it does
    with nulls, empty and repeated rows."""
    docs = table(spark, sf_dir, "documents").select(*COLUMNS)
    for name, apply in STAGES:
        docs = stage(apply(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-").lower())
    return docs
