"""From raw documents to packed token sequences: language, quality, near duplicates, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from copse.llm import jaccard, langid, packing, quality
from copse.session import new_folder


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that are in no learnt language: NULL, without letters, or with too few known trigrams."""
    return langid.filter_documents(docs)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that fail the base rules or lie beyond the thresholds of their language and source."""
    return quality.filter_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of linked ones: the one with the smallest id."""
    return jaccard.keep_one(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tokenize what is left and place its pieces in windows."""
    return packing.pack(docs)


STAGES = [("language_id", language), ("quality_rules", quality_rules), ("ngram_jaccard_join", near_duplicates), ("packing", pack)]

ORACLE_SQL = None
"""Training a filter and packing are beyond SQL; tests compare the stages with brute force."""


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn over ``documents``, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            path = new_folder(spark, f"stage-{name}")
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
