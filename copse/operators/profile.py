"""Null shares and label shares."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import percent_text


def null_rates(df: DataFrame) -> DataFrame:
    """Percent of NULLs per column, all columns in one pass."""
    wide = df.agg(*[F.try_divide(100.0 * F.count_if(F.col(c).isNull()), F.count("*")).alias(c) for c in df.columns])
    return wide.unpivot([], list(df.columns), "column_name", "null_percent")


def drop_sparse(df: DataFrame, threshold: float = 30.0) -> DataFrame:
    """Drop the columns with at least ``threshold`` percent NULLs."""
    sparse = [r["column_name"] for r in null_rates(df).filter(F.col("null_percent") >= threshold).collect()]
    return df.drop(*sparse)


def label_distribution(df: DataFrame, label: str) -> DataFrame:
    """Rows and percent per label value, NULLs aside."""
    counts = df.filter(F.col(label).isNotNull()).groupBy(label).agg(F.count("*").alias("n"))
    # One row per label value: a window over all of them is small.
    shared = counts.withColumn("total", F.sum("n").over(Window.partitionBy()))
    share = F.col("n") / F.col("total")
    return shared.select(label, "n", (100.0 * share).alias("percent"), percent_text(share).alias("percent_text"))


def class_counts(stages: dict[str, DataFrame], label: str) -> DataFrame:
    """Rows per class in each named frame, e.g. before and after resampling."""
    out = None
    for stage, df in stages.items():
        counts = df.groupBy(F.col(label).alias("label")).agg(F.count("*").alias("n"))
        counts = counts.select(F.lit(stage).alias("stage"), "label", "n")
        out = counts if out is None else out.unionByName(counts)
    return out
