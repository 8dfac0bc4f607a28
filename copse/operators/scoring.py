"""Scoring of rows by an ensemble, a batch of rows and one level of a tree at a time.

The chain of a whole ensemble's comparisons is more code than the JVM compiles for one loop, so batches are sent to a vectorized
function: per tree level one gather of features, splits and children for all rows of the batch.
"""

from __future__ import annotations

import sys
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F

from .route import Tree

# Send the functions of this module to tasks by value, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _arrays(tree: Tree, place: dict[int, int]) -> tuple:
    inner = np.array([not tree.is_leaf(i) for i in range(len(tree.heap))])
    feature = np.array([place.get(f, 0) if inner[i] else 0 for i, f in enumerate(tree.feature)], dtype=np.int64)
    value = np.array([np.nan if v is None else v for v in tree.value])
    return tree.height, inner, feature, np.array(tree.split), np.array(tree.left, dtype=np.int64), np.array(tree.heap, dtype=np.int64), value


def _ends(arrays: tuple, x: np.ndarray) -> np.ndarray:
    """Position of the leaf of each row; what is not at most the split goes right, missing values too."""
    height, inner, feature, split, left = arrays[:5]
    at, line = np.zeros(len(x), dtype=np.int64), np.arange(len(x))
    for _ in range(height):
        at = left[at] + (inner[at] & ~(x[line, feature[at]] <= split[at]))
    return at


def _columns(trees: Sequence[Tree], names: Sequence[str]) -> tuple[list[Column], dict[int, int]]:
    """The features that some tree looks at, the only ones that leave the scan; with none, a constant."""
    used = sorted(set().union(*[t.used_features() for t in trees]))
    cast = [F.col(names[i]).cast("double") for i in used]
    return cast or [F.lit(0.0)], {f: k for k, f in enumerate(used)}


def or_nan(value: Column) -> Column:
    """NaN leaves a vectorized function as NULL."""
    return F.coalesce(value, F.lit(float("nan")))


def margin(trees: Sequence[Tree], names: Sequence[str], start: float, rate: float) -> Column:
    """Start plus each tree's shrunken output, in the order of the trees; NaN where an output is undefined."""
    columns, place = _columns(trees, names)
    stored = [_arrays(t, place) for t in trees]

    def total(*x: pd.Series) -> pd.Series:
        table = np.stack([c.to_numpy(float) for c in x], axis=1)
        out = np.full(len(table), start)
        for arrays in stored:
            out = out + rate * arrays[6][_ends(arrays, table)]
        return pd.Series(out)

    return or_nan(F.pandas_udf(total, "double")(*columns))


def leaf(tree: Tree, names: Sequence[str]) -> Column:
    """Heap number and output of the row's leaf, as a struct ``leaf, value``."""
    columns, place = _columns([tree], names)
    arrays = _arrays(tree, place)

    def found(*x: pd.Series) -> pd.DataFrame:
        at = _ends(arrays, np.stack([c.to_numpy(float) for c in x], axis=1))
        return pd.DataFrame({"leaf": arrays[5][at], "value": arrays[6][at]})

    return F.pandas_udf(found, "leaf long, value double")(*columns)
