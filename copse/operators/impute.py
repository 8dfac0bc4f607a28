"""Filling missing values with exact medians and modes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .columns import numeric_columns
from .select import order_statistics


def _value(column: str):
    """NaN counts as missing, like NULL."""
    return F.nanvl(F.col(column).cast("double"), F.lit(None))


def medians(df: DataFrame, columns: Sequence[str]) -> dict[str, float | None]:
    """Exact median of each column, the mean of the two middle values for even counts.

    All columns share every pass, and no pass keeps a column in one buffer; ``df`` is read several times.
    """
    found = order_statistics(df, [_value(c) for c in columns], lambda n: [(n - 1) // 2, n // 2] if n else [])
    return {c: (v[0] + v[1]) / 2.0 if v else None for c, v in zip(columns, found)}


def modes(df: DataFrame, columns: Sequence[str]) -> dict[str, str | None]:
    """Most frequent value of each column as text, the smallest of equally frequent ones.

    Values are counted as rows of a table, not in a buffer, so a column may
    have any number of them.
    """
    if not columns:
        return {}
    parts = [a for c in columns for a in (F.lit(c), F.col(c).cast("string"))]
    long_rows = df.select(F.stack(F.lit(len(columns)), *parts).alias("c", "v")).filter("v IS NOT NULL")
    counts = long_rows.groupBy("c", "v").agg(F.count("*").alias("n"))
    best = counts.groupBy("c").agg(F.min(F.struct((-F.col("n")).alias("rank"), "v")).alias("best"))
    found = {r["c"]: r["v"] for r in best.select("c", "best.v").collect()}
    return {c: found.get(c) for c in columns}


def impute(df: DataFrame, skip: Sequence[str] = ()) -> DataFrame:
    """Fill numeric columns with their median and all others with their mode."""
    numeric = [c for c in numeric_columns(df) if c not in skip]
    other = [c for c in df.columns if c not in skip and c not in numeric]
    kinds = dict(df.dtypes)
    filled = {}
    for c, v in medians(df, numeric).items():
        if v is not None:
            # A half-way median needs a fraction, so integers become doubles then.
            kind = kinds[c] if float(v).is_integer() or kinds[c] in ("float", "double") else "double"
            base = F.nanvl(F.col(c), F.lit(None)) if kinds[c] in ("float", "double") else F.col(c)
            filled[c] = F.coalesce(base.cast(kind), F.lit(v).cast(kind))
    for c, v in modes(df, other).items():
        if v is not None:
            filled[c] = F.coalesce(F.col(c), F.lit(v).cast(kinds[c]))
    return df.withColumns(filled)
