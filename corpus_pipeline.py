"""Corpus pipeline: documents -> accepted, distinct, mixed documents -> token ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of
``documents``.  A stage's output is written as Parquet and read again by the next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from barspark.llm import exact_dedup, langid, mixing, queries, simhash
from barspark.session import materialize


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that no learnt language accepts (no letter, or a cross-entropy beyond the limits)."""
    return langid.drop_rejected(docs, queries.language_models(docs))


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the largest doc_id of equal texts (A-Z lower-cased)."""
    return exact_dedup.drop_duplicates(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the smallest doc_id of every SimHash component (3-word shingles, 3 differing bits)."""
    return simhash.drop_near_duplicates(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Samples documents by probabilities raked to the source, language and topic targets.

    They weigh the tokens that the next stage encodes them in."""
    return mixing.sample(docs, queries.MIX, tokens=queries.token_weights)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids and the decoded text, by the byte-level vocabulary."""
    return queries.encoded_digests(docs)


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_duplicates),
    ("near_dedup", near_duplicates),
    ("mix", mix_sources),
    ("encode", encode),
]

#: Character models and SimHash can't be written in SQL; tests compare every stage with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
