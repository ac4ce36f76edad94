"""A corpus from ``documents`` to packed sequences: five stages, each written as Parquet and read again by the next.

Language identification drops what it rejects, exact deduplication keeps one row per text, the Jaccard join keeps one
document per group of near copies, mixing repeats or drops documents so that sources reach their target weights, and
packing cuts what is left into token sequences. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rentmill.llm import exact_dedup, jaccard, language_id, mixing, packing
from rentmill.llm.tables import held_out, read_table, stored
from rentmill.operators.views import passed_to


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = language_id.fit(docs.where(~held_out("doc_id", 5, 0)))
    return language_id.keep_accepted(docs, model)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.drop_similar(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.take_copies(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", drop_exact_copies),
    ("jaccard_join", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

# Tokenising and the classifier have no SQL form; tests/llm/test_pipeline.py compares the stages with plain code.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = passed_to(spark, stored(stage(spark, docs, sf_dir), f"stage-{name}"))
    return docs
