"""A corpus pipeline in five stages; each is written as Parquet and read again by the next.

A stage is (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame. All
but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfmark.llm import bpe, decontaminate, jaccard_join, pii, quality
from shelfmark.llm.queries import RANKS
from shelfmark.llm.storage import stored


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the trained verdict."""
    return quality.filter_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def one_of_each_class(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    return jaccard_join.keep_one(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no test item."""
    return decontaminate.drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind; n_chars follows the text."""
    return pii.redact(docs).withColumn(
        "n_chars", F.when(F.col("text").isNotNull(), F.length("text")).otherwise(F.col("n_chars"))
        .cast("long"))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per document: number and digest of its ids, digest of what they decode to."""
    return bpe.bpe_round_trip(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN)


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", one_of_each_class),
    ("benchmark decontamination", without_benchmark),
    ("PII", without_personal_data),
    ("byte-level BPE", token_ids),
]

#: The trained verdict of the first stage and the merges of the last have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages after each other over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), "stage")
    return STAGES[-1][1](spark, docs, sf_dir)
