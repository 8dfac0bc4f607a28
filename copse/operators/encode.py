"""Categories to numbers by the mean label, shrunken to the overall mean."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..session import BROADCAST_ROWS, cut, skew_join

# Half-way count and slope of the shrinkage.
MIN_SAMPLES = 20.0
SMOOTHING = 10.0


@dataclass
class TargetEncoder:
    """Encodings of several columns; fit on one frame, apply to any."""

    columns: tuple[str, ...]
    prior: float
    table: DataFrame
    """``column, category, n, mean, encoded``"""
    rows: int

    @classmethod
    def fit(
        cls,
        df: DataFrame,
        columns: Sequence[str],
        label: str,
        min_samples: float = MIN_SAMPLES,
        smoothing: float = SMOOTHING,
    ) -> "TargetEncoder":
        """Counts and means of all columns from one map-side merged aggregation."""
        prior = df.agg(F.avg(F.col(label).cast("double"))).first()[0]
        if prior is None:
            raise ValueError("no label to learn from")
        parts = [a for c in columns for a in (F.lit(c), F.col(c).cast("string"))]
        long_rows = df.select(
            F.col(label).cast("double").alias("y"), F.stack(F.lit(len(columns)), *parts).alias("column", "category")
        ).filter("category IS NOT NULL")
        stats = long_rows.groupBy("column", "category").agg(F.count("y").alias("n"), F.avg("y").alias("mean"))
        weight = 1.0 / (1.0 + F.exp(-(F.col("n") - min_samples) / smoothing))
        encoded = F.lit(prior) * (1.0 - weight) + F.col("mean") * weight
        size = Observation("categories")
        table = cut(
            stats.withColumn("encoded", F.coalesce(encoded, F.lit(prior))).observe(size, F.count("*").alias("rows")),
            "encoding",
        )
        return cls(tuple(columns), prior, table, size.get["rows"] or 0)

    def transform(self, df: DataFrame, row_id: str | None = None) -> DataFrame:
        """Replace each category by its number; unknown and missing ones by the prior.

        Rows of a hot category are spread by ``row_id``, or without one by all columns together.
        """
        names = df.columns
        spread_by = F.col(row_id) if row_id else F.struct(*names)
        for c in self.columns:
            numbers = self.table.filter(F.col("column") == c).select(
                F.col("category").alias("_category"), F.col("encoded").alias("_encoded")
            )
            keyed = df.withColumn("_category", F.col(c).cast("string")).withColumn("_spread", F.xxhash64(spread_by))
            if self.rows <= BROADCAST_ROWS:
                joined = keyed.join(numbers.hint("broadcast"), "_category", "left")
            else:
                joined = skew_join(keyed, numbers, ["_category"], "_spread", how="left")
            df = joined.withColumn(c, F.coalesce("_encoded", F.lit(self.prior))).select(*names)
        return df
