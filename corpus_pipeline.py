"""The corpus pipeline: language ID, quality rules, near-dedup, repeated passages, packing.

Cases, for every stage: rows with a null or empty text are dropped by the first stage (no language) and do no harm to the others; a null doc_id is a document of its
own text; repeated rows stay until near-dedup leaves one; ties go to the least doc_id; very long texts are processed whole; empty tables give empty results; extra columns of any
name pass through all stages but packing, which gives pieces.

STAGES lists (name, function); each function takes (spark, docs, sf_dir) and returns a DataFrame. All but the last return
the columns of documents. SQL can't express the stages' tokenizers and models, so there is no ORACLE_SQL; the tests
hold the result against a brute-force version.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gantry.llm import language, neardup, packing, quality, repeats
from gantry.llm.shared import drop_written, private, written

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which a language is found; those without text or a letter go. Where lang is null it becomes the language found; without labels it stays null."""
    texts = language.training_texts(docs)
    if not texts:
        return language.with_letters(docs)
    predicted, score = private(docs, "lang_pred", "score")
    found = language.identify(docs, texts, found=(predicted, score)).filter(F.col(predicted) != language.UNKNOWN)
    return found.withColumn("lang", F.coalesce("lang", predicted)).select(*docs.columns)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules and their posterior keep."""
    judged = written(quality.judge(docs.select("doc_id", "text", F.xxhash64("text").alias("h"))).select("doc_id", "h", "kept"), "judged")
    bad = judged.filter(~F.col("kept")).select(F.col("doc_id").alias("_id"), F.col("h").alias("_h")).distinct()
    return docs.join(bad, docs["doc_id"].eqNullSafe(bad["_id"]) & (F.xxhash64(docs["text"]) == bad["_h"]), "left_anti")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of near-duplicates: five-word shingles, similarity of 0.8 or more."""
    return neardup.keep_first(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that one of a smaller doc_id has too."""
    return repeats.without_repeats(docs).withColumn("n_chars", F.length("text").cast("long"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 1024 tokens, along the Hilbert curve."""
    return packing.packed_digests(docs, TOKENIZER)


STAGES = [("language_id", language_id), ("quality_rules", quality_rules), ("near_dedup", near_dedup), ("repeated_passages", repeated_passages), ("packing", pack)]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES[:-1]):
        before, docs = docs, written(stage(spark, docs, sf_dir), name)
        if k:
            drop_written(before)
    return STAGES[-1][1](spark, docs, sf_dir)
