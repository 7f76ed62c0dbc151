"""The corpus pipeline: documents in, packed sequences out, one stage after another.

Each stage takes (spark, docs, sf_dir) and returns the documents that it keeps, with all
their columns; the last returns the pieces of the packed sequences. `run` writes every
stage's result to the shared folder and reads it back as the next one's input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from affinity.llm import decontaminate, exact_dedup, language, near_dedup, packing
from affinity.llm.common import table, written
from affinity.llm.contract import WINDOW, default_tokenizer, language_model

NEAR_WORDS, NEAR_PERCENT = 5, 80


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language; those without any letter (`und`) go."""
    return language.identified(docs, language_model(docs))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the largest doc_id."""
    return exact_dedup.exact_dedup(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document (the smallest doc_id) of each group of near duplicates."""
    return near_dedup.near_dedup(docs, NEAR_WORDS, NEAR_PERCENT)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of WINDOW tokens."""
    return packing.pack_documents(docs, default_tokenizer(), WINDOW, carry_ids=False)


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", drop_exact_copies),
    ("minhash_near_dedup", drop_near_copies),
    ("benchmark_decontamination", drop_benchmark_leaks),
    ("packing", pack),
]

# Language mixtures, MinHash and packing are no SQL; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
