"""Split search: one distributed job per tree level, for all nodes at once.

Rows come with ``node, g, h`` and, per feature ``i``, a value column ``x<i>``
and a bucket column ``b<i>``. Every search sums the rows of a bucket on the map
side, so a shuffle carries ``nodes * features * buckets`` cells at most, and
prefix sums over the cells of one node and feature are short windows. All sums
are exact (see ``sums``), so the same rows give the same splits on any
partitioning, and candidates that part the rows alike have equal gains.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import midpoint, split_gain
from ..params import BoostParams
from ..session import BROADCAST_ROWS, broadcast_if_small, cut
from . import bins
from .route import literal_array
from .sums import SUMS, parts, real, reals, totals

FINE_BLOCK_ROWS = 2_000_000
BY_VALUE_ROWS = 250_000
"""Levels of at most this many rows in all are searched by value at once, without blocks."""
SUB_QUANTILES = 255


@dataclass(frozen=True)
class Split:
    node: int
    f: int
    split: float
    gain: float
    gl: float
    hl: float
    nl: int
    gr: float
    hr: float
    nr: int


def by_feature(rows: DataFrame, features: Sequence[int], buckets: bool = True) -> DataFrame:
    """One row per row and feature: ``node``, parts of ``g`` and ``h``, ``f, [b,] v``."""
    stacked: list[Column] = []
    for i in features:
        stacked += [F.lit(i), *([F.col(f"b{i}")] if buckets else []), F.col(f"x{i}")]
    names = ("f", "b", "v") if buckets else ("f", "v")
    return rows.select("node", *parts(), F.stack(F.lit(len(features)), *stacked).alias(*names))


def value_cells(long_rows: DataFrame, *keys: str) -> DataFrame:
    """Gradient, hessian and row count of every distinct value."""
    return long_rows.groupBy("node", "f", *keys, "v").agg(*totals())


def node_hist(rows: DataFrame, features: Sequence[int]) -> DataFrame:
    """Sums per node, feature and distinct value, as numbers ``g, h, n`` and in exact parts."""
    return value_cells(by_feature(rows, features, buckets=False)).selectExpr("*", *reals(""))


def _gain(params: BoostParams) -> Column:
    return split_gain("gl", "hl", "gr", "hr", params.reg_lambda, params.gamma)


def _allowed(params: BoostParams) -> str:
    """Both sides hold rows, plus the optional size and weight rules."""
    ok = "nl > 0 AND nr > 0"
    if params.min_leaf is not None:
        ok += f" AND least(nl, nr) >= {int(params.min_leaf)}"
    if params.min_child_weight is not None:
        ok += f" AND least(hl, hr) > {float(params.min_child_weight)!r}D"
    return ok


def _valid(df: DataFrame, params: BoostParams) -> DataFrame:
    """Keep real candidates: a split value, both sides allowed, a defined gain."""
    kept = df.filter(f"split IS NOT NULL AND NOT isnan(split) AND {_allowed(params)}")
    return kept.withColumn("gain", _gain(params)).filter("gain IS NOT NULL AND NOT isnan(gain)")


def _right_side(df: DataFrame) -> DataFrame:
    """What is not left, and both sides as numbers."""
    sides = df.selectExpr("*", *[f"{c}_all - {c}l AS {c}r" for c in SUMS])
    return sides.selectExpr("*", *reals("l", "r"))


def _over(group: Sequence[str], order: str, frame: str) -> str:
    return f"OVER (PARTITION BY {', '.join(group)} ORDER BY {order} ROWS BETWEEN UNBOUNDED PRECEDING AND {frame})"


def _running(group: Sequence[str], order: str, suffix: str) -> list[str]:
    run = _over(group, order, "CURRENT ROW")
    return [f"sum({c}) {run} AS {c}{suffix}" for c in SUMS]


def _next(group: Sequence[str], order: str, value: str, name: str) -> str:
    return f"lead({value}) OVER (PARTITION BY {', '.join(group)} ORDER BY {order}) AS {name}"


def _prefix(cells: DataFrame, group: Sequence[str], order: str, *more: str) -> DataFrame:
    """Left sums up to and including each cell, and the totals of its group."""
    whole = _over(group, order, "UNBOUNDED FOLLOWING")
    over_all = [f"sum({c}) {whole} AS {c}_all" for c in SUMS]
    return cells.selectExpr("*", *_running(group, order, "l"), *over_all, *more)


# Order of preference: highest gain, then the smaller feature, then the smaller split value.
_BEST = "struct(-gain AS key, f, split, gain, gl, hl, nl, gr, hr, nr)"


def best_of(candidates: DataFrame) -> DataFrame:
    """The best candidate of every node."""
    best = candidates.groupBy("node").agg(F.expr(f"min({_BEST})").alias("best"))
    return best.selectExpr("node", *[f"best.{c}" for c in ("f", "split", "gain", "gl", "hl", "nl", "gr", "hr", "nr")])


def _as_splits(df: DataFrame) -> list[Split]:
    return [Split(**r.asDict()) for r in df.collect()]


# --- listing of all exact candidates -------------------------------------------------


def exact_candidates(hist: DataFrame, params: BoostParams) -> DataFrame:
    """Every midpoint of neighbouring distinct values with its sums and gain.

    The cells are range-partitioned on (node, feature, value) and written, so
    each part is a run of neighbours of bounded size. Sums run inside a part;
    what lies before it, and the first value after it, come from a table with
    one row per part, node and feature.
    """
    parts = cut(
        hist.repartitionByRange("node", "f", "v").withColumn("part", F.spark_partition_id()), "cells"
    )
    inside, over_parts = ("part", "node", "f"), ("node", "f")
    before, whole = _over(over_parts, "part", "1 PRECEDING"), _over(over_parts, "part", "UNBOUNDED FOLLOWING")
    offsets = (
        parts.groupBy("part", "node", "f")
        .agg(*[F.sum(c).alias(c) for c in SUMS], F.min("v").alias("lo"))
        .selectExpr(
            *inside,
            *[f"coalesce(sum({c}) {before}, 0) AS {c}_off" for c in SUMS],
            *[f"sum({c}) {whole} AS {c}_all" for c in SUMS],
            _next(over_parts, "part", "lo", "lo_next"),
        )
    )
    listed = parts.selectExpr("*", *_running(inside, "v", "_run"), _next(inside, "v", "v", "v_next"))
    listed = _with_offsets(listed.join(offsets, list(inside))).withColumn("v_next", F.coalesce("v_next", "lo_next"))
    return _valid(_right_side(_with_midpoint(listed)), params).select(
        "node", "f", "split", "gain", "gl", "hl", "nl", "gr", "hr", "nr"
    )


def _with_offsets(df: DataFrame) -> DataFrame:
    return df.selectExpr("*", *[f"{c}_run + {c}_off AS {c}l" for c in SUMS])


def _with_midpoint(df: DataFrame) -> DataFrame:
    """Split between a value and the next one; NaN is the greatest value and no midpoint leads to it."""
    return df.filter("v_next IS NOT NULL AND NOT isnan(v_next)").withColumn("split", midpoint("v", "v_next"))


def value_best(rows: DataFrame, features: Sequence[int], params: BoostParams) -> dict[int, Split]:
    """The best exact split of every node, by one sort of each node's values; for levels of few rows."""
    group = ("node", "f")
    cells = value_cells(by_feature(rows, features, buckets=False).repartition(*group))
    listed = _prefix(cells, group, "v", _next(group, "v", "v", "v_next"))
    found = best_of(_valid(_right_side(_with_midpoint(listed)), params))
    return {s.node: s for s in _as_splits(found)}


# --- search over buckets with fixed or per-node edges --------------------------------


def cut_cells(rows: DataFrame, features: Sequence[int]) -> DataFrame:
    """Sums per node, feature and bucket."""
    return by_feature(rows, features).groupBy("node", "f", "b").agg(*totals())


def with_siblings(cells: DataFrame, parents: DataFrame, pairs: dict[int, tuple[int, int]]) -> DataFrame:
    """``cells`` of one child of each parent, and those of the other one: what the parent's cells hold beyond them.

    ``pairs`` has the child with cells and the other one for each parent. The sums are exact, so the difference is too.
    """
    first, last = min(min(p) for p in pairs.values()), max(pairs)
    other_of_parent, other_of_child = [-1] * (last + 1), {}
    for parent, (known, other) in pairs.items():
        other_of_parent[parent] = other
        other_of_child[known] = other
    siblings = [other_of_child.get(i, -1) for i in range(first, max(other_of_child) + 1)]
    whole = parents.withColumn("node", F.get(literal_array(other_of_parent, "int"), F.col("node"))).filter("node >= 0")
    # Each cell counts for its own node, and against its sibling.
    other = F.get(literal_array(siblings, "int"), F.col("node") - first)
    signed = [F.struct(F.col("node"), *SUMS), F.struct(other.alias("node"), *[(-F.col(c)).alias(c) for c in SUMS])]
    both = cells.select("f", "b", F.explode(F.array(*signed)).alias("c")).select("c.node", "f", "b", *[f"c.{c}" for c in SUMS])
    # Dealt out as the running sums over them will need it.
    together = whole.unionByName(both).repartition("node", "f")
    return together.groupBy("node", "f", "b").agg(*[F.sum(c).alias(c) for c in SUMS]).filter("n > 0")


def cut_candidates(cells: DataFrame, cuts, params: BoostParams) -> DataFrame:
    """Candidates at the given cuts, from sums per right-closed bin of those cuts."""
    listed = _right_side(_prefix(cells, ("node", "f"), "b"))
    # All cuts in one array, each feature's from its own start.
    flat = literal_array([c for cs in cuts for c in cs], "double")
    starts = literal_array([sum(map(len, cuts[:i])) for i in range(len(cuts))], "int")
    sizes = literal_array([len(cs) for cs in cuts], "int")
    at = F.get(starts, F.col("f")) + F.col("b")
    listed = listed.withColumn("split", F.when(F.col("b") < F.get(sizes, F.col("f")), F.get(flat, at)))
    return _valid(listed, params)


def histogram_candidates(rows: DataFrame, features: Sequence[int], params: BoostParams, node_limit: int) -> DataFrame:
    """Candidates at the inner edges of equal-width bins, per node and feature.

    ``node_limit`` bounds the nodes among the rows; it decides whether the
    table of value ranges is small enough to broadcast.
    """
    ranges = rows.groupBy("node").agg(
        *[a for i in features for a in (F.min(f"x{i}").alias(f"lo{i}"), F.max(_finite(f"x{i}")).alias(f"hi{i}"))]
    )
    k = params.num_bins
    ranged = rows.join(broadcast_if_small(ranges, node_limit), "node")
    stacked: list[Column] = []
    for i in features:
        stacked += [F.lit(i), F.col(f"x{i}"), F.col(f"lo{i}"), F.col(f"hi{i}")]
    long_rows = ranged.select("node", *parts(), F.stack(F.lit(len(features)), *stacked).alias("f", "v", "lo", "hi"))
    v, lo, hi = F.col("v"), F.col("lo"), F.col("hi")
    cells = (
        long_rows.withColumn("b", F.when(F.isnan(v), k).otherwise(bins.equal_width_bin(v, lo, hi, k)))
        .groupBy("node", "f", "b", "lo", "hi")
        .agg(*totals())
    )
    listed = _right_side(_prefix(cells, ("node", "f"), "b")).withColumn(
        "split", F.when(F.col("b") < k - 1, bins.equal_width_edge(lo, hi, F.col("b") + 1, k))
    )
    return _valid(listed, params)


def _finite(column: str) -> Column:
    return F.nanvl(F.col(column), F.lit(None))


# --- exact search --------------------------------------------------------------------


def _judge(blocks: DataFrame, best: dict[int, Split], params: BoostParams) -> DataFrame:
    """Mark the blocks that may hide a better split than the best one known for their node.

    The gain is convex in the left sums (G, H). Inside a block these stay in
    the box spanned by its negative and positive gradient and by its hessian,
    so the best corner of the box is an upper bound. Float noise gets a margin,
    and a corner without a defined gain counts as unbounded.
    """
    lam, gamma = params.reg_lambda, params.gamma
    blocks = blocks.selectExpr("*", *reals("", "_all"), f"{real('p')} AS gp")
    if best:
        first, last = min(best), max(best)
        gains = [best[i].gain if i in best else None for i in range(first, last + 1)]
        known = F.nanvl(F.get(literal_array(gains, "double"), F.col("node") - first), F.lit(None))
    else:
        # First round, nothing known yet: a node has features * (2 * quantiles + 1) blocks at most.
        known = F.max("edge.gain").over(Window.partitionBy("node"))
    blocks = blocks.withColumn("best_gain", known)
    corners = [
        split_gain(f"gl - ({dg})", f"hl - {dh}", f"g_all - gl + ({dg})", f"h_all - hl + {dh}", lam, gamma)
        for dg in ("gp", "g - gp")  # from the right end: all but the negative, or all but the positive part
        for dh in ("0D", "h")
    ]
    limit = F.greatest(*[F.coalesce(c, F.lit(math.inf)) for c in corners])
    size = F.try_divide(F.col("g_all") * F.col("g_all"), F.col("h_all") + lam)
    slack = 1e-8 + 1e-10 * (F.abs("best_gain") + F.coalesce(size, F.lit(0.0)))
    can_win = F.col("best_gain").isNull() | (limit + slack >= F.col("best_gain"))
    return blocks.withColumn("alive", (F.col("lo") < F.col("hi")) & can_win)


def _blocks(long_rows: DataFrame, *outer: str) -> DataFrame:
    rising = F.col("g1") >= 0
    return long_rows.groupBy("node", "f", *outer, "b").agg(
        *totals(),
        F.sum(F.when(rising, F.col("g1")).otherwise(0)).alias("p1"),
        F.sum(F.when(rising, F.col("g0")).otherwise(0)).alias("p0"),
        F.min("v").alias("lo"),
        F.max("v").alias("hi"),
    )


def _with_edges(blocks: DataFrame, params: BoostParams) -> DataFrame:
    """Add the candidate between a block's greatest value and the next one's smallest."""
    gain = F.when(F.expr(f"lo_next IS NOT NULL AND NOT isnan(lo_next) AND {_allowed(params)}"), _gain(params))
    edged = blocks.withColumns({"gain": F.nanvl(gain, F.lit(None)), "split": midpoint("hi", "lo_next")})
    return edged.withColumn("edge", F.expr(f"CASE WHEN gain IS NOT NULL THEN {_BEST} END")).drop("gain", "split")


def _merge(best: dict[int, Split], found: Sequence[Split]) -> None:
    def key(s: Split) -> tuple:
        return -s.gain, s.f, s.split

    for s in found:
        if s.node not in best or key(s) < key(best[s.node]):
            best[s.node] = s


def exact_best(
    rows: DataFrame,
    features: Sequence[int],
    params: BoostParams,
    fine_block_rows: int = FINE_BLOCK_ROWS,
    broadcast_rows: int = BROADCAST_ROWS,
) -> dict[int, Split]:
    """The best exact split of every node, from coarse blocks to single values.

    1. Sum the rows per block of neighbouring values. Splits between blocks are
       exact candidates already.
    2. Drop each block whose upper bound cannot reach the node's best edge;
       blocks with one value have no inner split.
    3. Look into the rest: by single values where blocks hold few rows,
       else by cutting them into smaller blocks and starting over.

    Nothing is left out by steps 2 and 3, so the result is that of a search
    over all values, while only rows of undecided blocks are shuffled by value.
    """
    best: dict[int, Split] = {}
    if not features:
        return best
    held: list[DataFrame] = []
    long_rows = by_feature(rows, features)
    group = ("node", "f")
    blocks = _right_side(_prefix(_blocks(long_rows), group, "b"))
    try:
        while True:
            blocks = blocks.selectExpr("*", _next(group, "b", "lo", "lo_next"))
            blocks = _with_edges(blocks, params)
            if held:
                blocks = blocks.persist()
                held.append(blocks)
                edges = blocks.groupBy("node").agg(F.min("edge").alias("best")).collect()
                _merge(best, [Split(r["node"], *r["best"][1:]) for r in edges if r["best"] is not None])
            blocks = _judge(blocks, best, params)
            if not held:
                blocks = blocks.persist()
                held.append(blocks)
            found = blocks.groupBy("node").agg(
                F.min("edge").alias("best"),
                F.count_if("alive").alias("blocks"),
                F.max(F.when(F.col("alive"), F.col("n"))).alias("rows"),
                F.collect_set(F.when(F.col("alive"), F.col("f"))).alias("f"),
            ).collect()
            _merge(best, [Split(r["node"], *r["best"][1:]) for r in found if r["best"] is not None])
            count = sum(r["blocks"] for r in found)
            if not count:
                return best
            most = max(r["rows"] or 0 for r in found)
            open_features = sorted({f for r in found for f in r["f"]})
            alive = blocks.filter("alive")
            base = alive.select(
                "node", "f", "b", *[f"{c}_all" for c in SUMS],
                *[(F.col(f"{c}l") - F.col(c)).alias(f"{c}_off") for c in SUMS],
            )
            hinted = count <= broadcast_rows
            base = base.hint("broadcast") if hinted else base
            if len(held) == 1:
                long_rows = by_feature(rows, open_features)  # closed features are not even read
            undecided = long_rows.filter(F.col("f").isin(open_features)).join(
                base.select("node", "f", "b"), ["node", "f", "b"], "left_semi"
            )
            if most <= fine_block_rows:
                _merge(best, _as_splits(best_of(_inner_candidates(undecided, base, params))))
                return best
            long_rows, blocks = _subdivide(undecided, base, hinted)
            group = ("node", "f", "outer")
    finally:
        for df in held:
            df.unpersist()


def _subdivide(undecided: DataFrame, base: DataFrame, hinted: bool) -> tuple[DataFrame, DataFrame]:
    """Cut each undecided block at its own quantiles; new rows and new blocks.

    The quantiles are approximate and may differ when recomputed, so they are
    written once. Frequent values again get blocks of their own.
    """
    points = bins.quantile_points(SUB_QUANTILES)
    sketches = undecided.groupBy("node", "f", "b").agg(
        F.array_distinct(F.percentile_approx("v", points, 20 * SUB_QUANTILES)).alias("cuts")
    )
    sketches = cut(sketches, "cuts")
    sketches = sketches.hint("broadcast") if hinted else sketches
    width = 2 * (SUB_QUANTILES + 1)
    finer = undecided.join(sketches, ["node", "f", "b"]).select(
        "node", *SUMS[:-1], "f", F.col("b").cast("long").alias("outer"), "v",
        (F.col("b").cast("long") * width + bins.search(F.col("cuts"), F.col("v"), SUB_QUANTILES)).alias("b"),
    )
    group = ("node", "f", "outer")
    blocks = _blocks(finer, "outer").selectExpr("*", *_running(group, "b", "_run"))
    outer = base.withColumn("outer", F.col("b").cast("long")).drop("b")
    outer = outer.hint("broadcast") if hinted else outer
    return finer.drop("outer"), _right_side(_with_offsets(blocks.join(outer, list(group))))


def _inner_candidates(undecided: DataFrame, base: DataFrame, params: BoostParams) -> DataFrame:
    # Values that many rows share have blocks of their own and are not among
    # these, so rows are moved once, by block, and summed and sorted in place.
    inside = ("node", "f", "b")
    cells = value_cells(undecided.repartition(*inside), "b")
    listed = cells.selectExpr("*", *_running(inside, "v", "_run"), _next(inside, "v", "v", "v_next"))
    # The last value of a block has no next one here: its candidate is the block's edge.
    return _valid(_right_side(_with_offsets(_with_midpoint(listed).join(base, list(inside)))), params)
