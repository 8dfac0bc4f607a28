"""Sums of gradients and hessians that do not depend on the order of their terms.

A number is cut into whole multiples of 2^-26 and, of what is left, of 2^-52; what is below is dropped. Both parts are added as longs, exactly, so
partial sums may be merged, subtracted and run over in any order and on any partitioning. Terms up to 1 leave room for 2^36 rows.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

STEPS = float(1 << 26)
SUMS = ("g1", "g0", "h1", "h0", "n")
"""Columns of a sum: upper and lower part of gradient and hessian, and the number of rows."""


def parts(rest: tuple[str, ...] = ("g", "h")) -> list[Column]:
    """Upper and lower part of each column, named ``<column>1`` and ``<column>0``."""
    out = []
    for c in rest:
        scaled = F.col(c) * STEPS
        out += [F.floor(scaled).alias(f"{c}1"), F.floor((scaled - F.floor(scaled)) * STEPS).alias(f"{c}0")]
    return out


def totals() -> list[Column]:
    """Aggregates of the parts of rows or of other sums' rows, and the row count."""
    return [*[F.sum(c).alias(c) for c in SUMS[:-1]], F.count("*").alias("n")]


def real(name: str, suffix: str = "") -> str:
    """The number that a pair of parts stands for, as SQL text."""
    return f"({name}1{suffix} * {1 / STEPS!r}D + {name}0{suffix} * {1 / STEPS / STEPS!r}D)"


def reals(*suffixes: str) -> list[str]:
    """``g<suffix>`` and ``h<suffix>`` as numbers, as SQL text."""
    return [f"{real(c, s)} AS {c}{s}" for s in suffixes for c in ("g", "h")]
