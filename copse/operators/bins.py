"""Cut points per feature and the bucket columns made from them."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .select import order_statistics

BLOCK_ROUNDS = 2
"""Blocks of an exact search need no exact quantiles: wherever they are cut, the result is the same."""
BLOCK_QUANTILES = 4095
"""The smaller a block, the closer the bound on what it can hide, and the fewer rows are looked at by value."""


def quantile_points(count: int) -> list[float]:
    return [(i + 1) / (count + 1) for i in range(count)]


def eps_points(eps: float) -> list[float]:
    """Ranks ``eps, 2*eps, ...`` below 1."""
    steps = math.ceil(round(1.0 / eps, 9)) - 1
    return [round(eps * (i + 1), 12) for i in range(steps)]


WEIGHT_STEPS = float(1 << 26)


def whole_weight(hessian: Column) -> Column:
    """A hessian as a whole number of 2^-26, so sums of weights are exact."""
    return F.floor(hessian * WEIGHT_STEPS)


def quantile_cuts(
    df: DataFrame, columns: Sequence[str], points: Sequence[float], rounds: int | None = None, weight: Column | None = None
) -> list[list[float]]:
    """Distinct finite quantiles of every column: the least value that at least the share ``p`` of all (by number, or by ``weight``) do not exceed.

    Exact and the same on any partitioning; with ``rounds``, near enough to cut blocks by. ``df`` is read several times.
    """

    def ranks(n: int) -> list[int]:
        # Float noise in the product must not move a rank: 0.55 * 6000 is 3300.
        return [max(1, math.ceil(round(p * n, 6))) - 1 for p in points]

    found = order_statistics(df, [F.col(c) for c in columns], ranks, rounds, weight)
    return [sorted({v for v in vs if math.isfinite(v)}) for vs in found]


def _bucketed(df: DataFrame, inputs: Sequence[str], outputs: Sequence[str], bounds) -> DataFrame:
    """Bucket numbers by JVM binary search; NaN gets the bucket after the last."""
    binned = Bucketizer(
        splitsArray=[[-math.inf, *b, math.inf] for b in bounds],
        inputCols=list(inputs),
        outputCols=list(outputs),
        handleInvalid="keep",
    ).transform(df)
    return binned.withColumns({c: F.col(c).cast("int") for c in outputs})


def _split_columns(df: DataFrame, inputs, outputs, bounds) -> DataFrame:
    """Bucketize the columns that have bounds; the others have the one bucket 0."""
    cut = [i for i, b in enumerate(bounds) if b]
    flat = {outputs[i]: F.lit(0) for i, b in enumerate(bounds) if not b}
    if flat:
        df = df.withColumns(flat)
    if cut:
        df = _bucketed(df, [inputs[i] for i in cut], [outputs[i] for i in cut], [bounds[i] for i in cut])
    return df


def with_blocks(df: DataFrame, inputs, outputs, cuts: Sequence[Sequence[float]]) -> DataFrame:
    """Blocks of neighbouring values: every cut is a block of its own, with one
    block between each two cuts.

    A frequent value is a cut, so it never shares a block with others, and a
    block of mixed values holds few rows.
    """
    bounds = [sorted({e for c in cs for e in (c, math.nextafter(c, math.inf))}) for cs in cuts]
    return _split_columns(df, inputs, outputs, bounds)


def with_right_closed_bins(df: DataFrame, inputs, outputs, cuts: Sequence[Sequence[float]]) -> DataFrame:
    """Bin ``j`` holds the values above cut ``j-1`` up to and including cut ``j``."""
    bounds = [[math.nextafter(c, math.inf) for c in cs] for cs in cuts]
    return _split_columns(df, inputs, outputs, bounds)


def equal_width_edge(lo: Column, hi: Column, j: Column, bins: int) -> Column:
    return lo + (hi - lo) * j / F.lit(float(bins))


def equal_width_bin(v: Column, lo: Column, hi: Column, bins: int) -> Column:
    """Right-closed equal-width bin of ``v``, in step with the edges' own rounding."""
    rough = F.least(F.greatest(F.floor(F.try_divide(v - lo, hi - lo) * bins), F.lit(0)), F.lit(bins - 1))
    low = F.when((rough > 0) & (v <= equal_width_edge(lo, hi, rough, bins)), 1).otherwise(0)
    high = F.when((rough < bins - 1) & (v > equal_width_edge(lo, hi, rough + 1, bins)), 1).otherwise(0)
    return F.coalesce(rough - low + high, F.lit(0)).cast("int")


def search(cuts: Column, v: Column, size: int) -> Column:
    """Block number of ``v`` in a sorted array column of at most ``size`` cuts.

    Twice the number of cuts below ``v``, plus one where ``v`` is a cut: the
    numbering of :func:`with_blocks` for cuts that differ from row to row.
    """
    steps = [1 << k for k in range(max(size, 1).bit_length() - 1, -1, -1)]
    below = F.aggregate(
        F.array(*[F.lit(s) for s in steps]),
        F.lit(0),
        lambda at, step: at + F.when(F.get(cuts, at + step - 1) < v, step).otherwise(0),
    )
    return (below * 2 + F.when(F.get(cuts, below) == v, 1).otherwise(0)).cast("int")
