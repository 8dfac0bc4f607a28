"""Choosing and reshaping columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import skew_join
from .rank import ranked

MAX_CATEGORIES = 10_000


def drop_by_position(df: DataFrame, start: int, stop: int) -> DataFrame:
    return df.drop(*df.columns[start:stop])


def drop_by_name(df: DataFrame, *names: str) -> DataFrame:
    return df.drop(*names)


def split_label(df: DataFrame, label: str) -> tuple[list[str], str]:
    """Names of the features and of the label; both stay in one frame."""
    return [c for c in df.columns if c != label], label


def drop_null_rows(df: DataFrame) -> DataFrame:
    return df.dropna("any")


def head_rows(df: DataFrame, row_id: str, count: int) -> DataFrame:
    """The ``count`` rows with the smallest ids."""
    return df.orderBy(row_id).limit(count)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def standardize(df: DataFrame, label: str, keep: Sequence[str] = ()) -> DataFrame:
    """Numeric columns but the label to zero mean and unit (population) deviation.

    One aggregation to a single row, then a projection; constant columns are
    only centred.
    """
    names = [c for c in numeric_columns(df) if c != label and c not in keep]
    if not names:
        return df
    row = df.agg(
        *[a for i, c in enumerate(names) for a in (F.avg(c).alias(f"m{i}"), F.stddev_pop(c).alias(f"s{i}"))]
    ).first()
    scaled = {}
    for i, c in enumerate(names):
        mean, deviation = row[f"m{i}"], row[f"s{i}"]
        if mean is not None:
            scaled[c] = (F.col(c) - F.lit(mean)) / F.lit(deviation or 1.0)
    return df.withColumns(scaled)


def one_hot(df: DataFrame, column: str, limit: int = MAX_CATEGORIES) -> DataFrame:
    """Replace a category column by one 0/1 column per value.

    Every value becomes a column, so a column with more than ``limit`` values
    is refused rather than cut short; ``one_hot_sparse`` takes any number.
    """
    values = [r[0] for r in df.select(column).distinct().limit(limit + 2).collect()]
    values = sorted(v for v in values if v is not None)
    if len(values) > limit:
        raise ValueError(f"{column} has more than {limit} values")
    # A NULL category is 0 in every column.
    flags = {f"{column}_{v}": F.when(F.col(column) == F.lit(v), 1).otherwise(0) for v in values}
    return df.withColumns(flags).drop(column)


def category_index(df: DataFrame, column: str, name: str = "index") -> DataFrame:
    """The distinct values of a column, numbered from 0 in their order (written); NULL is none of them."""
    values = df.select(column).filter(F.col(column).isNotNull()).distinct()
    return ranked(values, [F.col(column)], name).withColumn(name, F.col(name) - 1)


def one_hot_sparse(df: DataFrame, row_id: str, column: str) -> DataFrame:
    """The non-zero entries of the 0/1 matrix of a category column: ``row_id, index, value``.

    Columns of the matrix are numbered by ``category_index``, without any value on the driver. Rows with a NULL category have no
    entry. A frequent value's rows are spread over several tasks.
    """
    rows = df.select(row_id, column).filter(F.col(column).isNotNull())
    return skew_join(rows, category_index(df, column), [column], row_id).select(row_id, "index", F.lit(1).alias("value"))
