"""Labelled frames over the star-schema tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LI_FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
ORD_FEATURES = ["o_totalprice", "c_acctbal"]
ORD_CATEGORIES = ["o_orderpriority", "c_mktsegment"]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def li_xy(spark: SparkSession, folder: str) -> DataFrame:
    """Line items, returned ones as class 1."""
    li = table(spark, folder, "lineitem")
    return li.select((F.col("l_returnflag") == "R").cast("int").alias("label"), *LI_FEATURES)


def ord_xy(spark: SparkSession, folder: str) -> DataFrame:
    """Orders with their customer, finished ones as class 1."""
    orders, customer = table(spark, folder, "orders"), table(spark, folder, "customer")
    joined = orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
    label = (F.col("o_orderstatus") == "F").cast("int").alias("label")
    return joined.select(F.col("o_orderkey").alias("row_id"), label, *ORD_FEATURES, *ORD_CATEGORIES)


def doc_xy(spark: SparkSession, folder: str) -> DataFrame:
    """Documents with their labels, NULL where there are none."""
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    return docs.join(labels, "doc_id", "left").select(
        F.col("doc_id").alias("row_id"), F.col("quality").alias("label"), "n_chars", "toxic", "lang", "source"
    )


def emb_xy(spark: SparkSession, folder: str) -> DataFrame:
    """Embeddings, the first group as class 1."""
    emb = table(spark, folder, "embeddings")
    return emb.select(
        F.col("vec_id").alias("row_id"),
        (F.col("label") == 0).cast("int").alias("label"),
        F.col("embedding").cast("array<double>").alias("embedding"),
    )


def ev_xy(events: DataFrame) -> DataFrame:
    """Events, purchases as class 1; for batch and streaming frames."""
    label = (F.col("event_type") == "purchase").cast("int").alias("label")
    return events.select("event_id", label, "value", F.hour("ts").cast("double").alias("hour"))
