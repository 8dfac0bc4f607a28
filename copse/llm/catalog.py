"""The text operators as queries over the given tables, with their production parameters, and SQL twins where SQL can say the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from copse.llm import fingerprint, jaccard, langid, licenses, merkle, negatives, packing, pieces, quality, render, sharding, slack, twins, warc

SHARDS = [f"shard-{i:04d}" for i in range(256)]


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/pages.parquet")


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shard of each document among 256, and the one it has when there is one shard more."""
    docs = _documents(spark, sf_dir).select("doc_id")
    placed = sharding.place(docs, ["doc_id"], SHARDS)
    return sharding.place(placed, ["doc_id"], [*SHARDS, f"shard-{len(SHARDS):04d}"], out="shard_if_added")


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.predict(_documents(spark, sf_dir))


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ids of each document's text, the text that they decode to, and the path of the largest sum of scores."""
    encoded = pieces.encode(_documents(spark, sf_dir)).withColumn("n_ids", F.size("ids"))
    return pieces.with_decoded(encoded)


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.roundtrip(spark, _pages(spark, sf_dir))


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(_documents(spark, sf_dir))


def op6_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.component_table(_documents(spark, sf_dir))


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return render.extract(_pages(spark, sf_dir))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_documents(spark, sf_dir))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(_documents(spark, sf_dir))


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.compare(_documents(spark, sf_dir))


def op11_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return slack.pack(_documents(spark, sf_dir))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return negatives.mine(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verify(_documents(spark, sf_dir))


QUERIES = {
    f.__name__: f
    for f in (
        op1_sharding, op2_language_id, op3_sentencepiece, op4_warc, op5_license_scan, op6_ngram_jaccard, op7_html_text,
        op8_packing, op9_quality_rules, op10_fingerprints, op11_best_fit_packing, op12_hard_negatives, op13_merkle_manifest,
    )
}

SQL = twins.SQL
