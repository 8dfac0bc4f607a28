"""Exact ranks, samples and splits without a sort in one task."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import broadcast_if_small, cut
from .tree import round_half_up

BOUNDARY_ROWS = 100_000


def draw_key(row_id: str, seed: int) -> Column:
    """Hash that orders rows at random but always alike."""
    return F.md5(F.concat(F.col(row_id).cast("string"), F.lit(f":{seed}")))


def smallest(
    df: DataFrame,
    row_id: str,
    count: int | Callable[[int], int],
    seed: int,
    boundary_rows: int = BOUNDARY_ROWS,
) -> Column:
    """Condition that holds for exactly the ``count`` rows first in draw order.

    ``count`` may be a function of the number of rows, which is known anyway
    after the first pass.

    The draw key of the last of them is found by counting keys per prefix and
    then looking only at rows with the prefix where the count is reached, so no
    more than ``boundary_rows`` keys are ever sorted together. The condition
    compares with that key: applying it needs no shuffle.
    ``row_id`` must be unique; equal ids would share a key.
    """
    keys = df.select(draw_key(row_id, seed).alias("k"), F.col(row_id).cast("string").alias("id"))
    prefix, rest = "", count
    while len(prefix) < 32:
        at = len(prefix)
        inside = keys.filter(F.col("k").startswith(prefix)) if prefix else keys
        # At most 16**4 prefixes per round.
        counts = inside.groupBy(F.substring("k", at + 1, 4).alias("p")).count().collect()
        if not prefix:
            total = sum(r["count"] for r in counts)
            rest = count(total) if callable(count) else count
            if not 0 < rest < total:
                return F.lit(rest > 0)
        size = 0
        for p, n in sorted((r["p"], r["count"]) for r in counts):
            if rest <= n:
                prefix, size = prefix + p, n
                break
            rest -= n
        if size <= boundary_rows:
            break
    order = Window.orderBy("k", "id")
    last = (
        keys.filter(F.col("k").startswith(prefix))
        .withColumn("r", F.row_number().over(order))
        .filter(F.col("r") == rest)
        .first()
    )
    key, ident = draw_key(row_id, seed), F.col(row_id).cast("string")
    return (key < last["k"]) | ((key == last["k"]) & (ident <= last["id"]))


def train_test_split(
    df: DataFrame, row_id: str, test_size: float = 0.2, seed: int = 0, part: str = "part"
) -> DataFrame:
    """Mark every row 'train' or 'test'; exactly ``floor(n * test_size)`` rows are test."""
    train = smallest(df, row_id, lambda n: n - int(n * test_size), seed)
    return df.withColumn(part, F.when(train, "train").otherwise("test"))


def row_sample(df: DataFrame, row_id: str, ratio: float, seed: int = 0) -> DataFrame:
    """Exactly ``round(n * ratio)`` rows, drawn without replacement."""
    if ratio >= 1.0:
        return df
    return df.filter(smallest(df, row_id, lambda n: round_half_up(n * ratio), seed))


def ranked(df: DataFrame, order: Sequence[Column], name: str = "rank") -> DataFrame:
    """Number all rows from 1 in the given order.

    Rows are range-partitioned on the whole order, so ties on its first part
    are spread out, sorted within their part and written with their place in
    it. Each row's number is that place plus the rows of the parts before.
    """
    place = F.monotonically_increasing_id()  # part number in the upper bits, place in the lower 33
    placed = cut(
        df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_place", place), "ranked"
    )
    part = F.shiftright("_place", 33)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (
        placed.withColumn("_part", part)
        .join(broadcast_if_small(offsets, parts), "_part")
        .withColumn(name, F.col("_before") + F.col("_place") - F.shiftleft("_part", 33) + 1)
        .drop("_part", "_place", "_before")
    )


def sort_column(df: DataFrame, column: str, row_id: str, ascending: bool = True) -> DataFrame:
    """The frame ordered by one column, either way, and on ties by ``row_id``, which spreads a frequent value over tasks."""
    return df.orderBy(F.col(column).asc() if ascending else F.col(column).desc(), F.col(row_id))


def merge_sorted(first: DataFrame, second: DataFrame, column: str, row_id: str, source: str = "src", name: str = "rank") -> DataFrame:
    """Two runs as one, numbered in their common order; on ties rows of the first come first, then smaller ids."""
    both = first.withColumn(source, F.lit(0)).unionByName(second.withColumn(source, F.lit(1)))
    return ranked(both, [F.col(column), F.col(source), F.col(row_id)], name)


def value_rank(df: DataFrame, value: str, idx: str, name: str = "rank") -> DataFrame:
    """Rank by ascending value, ties by descending index."""
    return ranked(df, [F.col(value).asc(), F.col(idx).desc()], name)
