"""Trees as constants of a plan, and the walk of a row from the root to its leaf.

A tree has at most ``2**(depth+1)`` nodes and comes from the driver anyway, so
it enters a plan as literal arrays: no join, no shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROOT = 1


@dataclass
class Tree:
    """Nodes in order of growth; children of node ``i`` are ``left[i]`` and the one after it."""

    heap: list[int] = field(default_factory=list)
    depth: list[int] = field(default_factory=list)
    n: list[int] = field(default_factory=list)
    g: list[float] = field(default_factory=list)
    h: list[float] = field(default_factory=list)
    feature: list[int] = field(default_factory=list)
    split: list[float] = field(default_factory=list)
    gain: list[float | None] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    value: list[float | None] = field(default_factory=list)
    features: tuple[int, ...] = ()

    def add(self, heap: int, depth: int, n: int, g: float, h: float) -> int:
        at = len(self.heap)
        self.heap.append(heap)
        self.depth.append(depth)
        self.n.append(n)
        self.g.append(g)
        self.h.append(h)
        # A leaf leads to itself: no value, NaN included, is above NaN in Spark's order.
        self.feature.append(0)
        self.split.append(float("nan"))
        self.gain.append(None)
        self.left.append(at)
        self.value.append(None)
        return at

    def is_leaf(self, at: int) -> bool:
        return self.left[at] == at

    @property
    def height(self) -> int:
        return max(self.depth, default=0)

    def used_features(self) -> set[int]:
        return {f for i, f in enumerate(self.feature) if not self.is_leaf(i)}


def _text(value) -> str:
    if value is None:
        return "NaN"
    return {"nan": "NaN", "inf": "Infinity", "-inf": "-Infinity"}.get(repr(value), repr(value))


def literal_array(values: Sequence, kind: str) -> Column:
    """One string literal, folded into an array constant when the query is planned."""
    if not values:
        return F.array().cast(f"array<{kind}>")
    return F.split(F.lit(",".join(map(_text, values))), ",").cast(f"array<{kind}>")


def features_array(used: set[int], total: int) -> Column:
    """Feature array with NULL for columns no tree looks at, so scans can skip them."""
    return F.array(*[F.col(f"x{i}") if i in used else F.lit(None).cast("double") for i in range(total)])


def descend(rows: DataFrame, tree: Tree, total: int, since: int = 0) -> DataFrame:
    """Add ``node``, the position (in the tree's node order) where each row ends.

    With ``since`` the rows have a ``node`` already, as far as that depth. There is one projection for each level; they are compiled into
    one loop over the rows, with the tree's arrays as constants, and each looks at one node.
    """
    if not since:
        rows = rows.withColumn("node", F.lit(0))
    if tree.height == since:
        return rows
    feature, split, left = literal_array(tree.feature, "int"), literal_array(tree.split, "double"), literal_array(tree.left, "int")
    rows = rows.withColumn("_x", features_array(tree.used_features(), total))
    at = F.col("node")
    # Right if above the split; a missing value counts as NaN, above all else.
    value = F.coalesce(F.get("_x", F.get(feature, at)), F.lit(float("nan")))
    for _ in range(since, tree.height):
        rows = rows.withColumn("node", F.get(left, at) + F.when(value > F.get(split, at), 1).otherwise(0))
    return rows.drop("_x")


def leaf_output(tree: Tree) -> Column:
    """Output of the leaf in ``node``; NaN where it is undefined."""
    return F.get(literal_array(tree.value, "double"), F.col("node"))
