"""Order statistics of many columns at once, by radix selection: nothing is sorted, and six rounds suffice for any column.

Doubles are numbered in their order by 64-bit integers. A round counts the rows by the next eleven bits of these numbers, for every cell that
still holds a wanted rank, in a map-side merged aggregate; running sums over a cell's parts, 2,048 at most, tell which part holds the rank.
Leading bits that a cell's values share are skipped, so usual data take two or three rounds.
"""

from __future__ import annotations

import struct
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DIGIT_BITS = 11
_MASK = 0x7FFF_FFFF_FFFF_FFFF


def _double(number: int) -> float:
    value = struct.unpack("<d", struct.pack("<q", abs(number)))[0]
    return -value if number < 0 else value


def numbered(df: DataFrame, columns: Sequence[Column], names: Sequence[str], weight: Column | None = None) -> DataFrame:
    """The columns as numbers in the order of their values, 0 for both zeros, NULL for NULL and NaN; and the row's weight ``_w``."""
    own = (F.lit(1) if weight is None else weight).cast("long").alias("_w")
    values = df.select(own, *[F.nanvl(c.cast("double"), F.lit(None)).alias(n) for c, n in zip(columns, names)])
    text = [F.when(F.col(n).isNotNull(), F.java_method(F.lit("java.lang.Double"), F.lit("doubleToLongBits"), F.col(n))) for n in names]
    bits = values.select("_w", *[t.cast("long").alias(n) for t, n in zip(text, names)])
    return bits.filter("_w > 0").select("_w", *[F.when(F.col(n) >= 0, F.col(n)).otherwise(-F.col(n).bitwiseAND(_MASK)).alias(n) for n in names])


@dataclass(frozen=True)
class _Cell:
    """Numbers from ``lo`` to ``hi`` of one column, ``below`` smaller ones before them."""

    lo: int
    hi: int
    below: int

    @property
    def width(self) -> int:
        """Bits after those that all numbers of the cell share."""
        return ((self.lo ^ self.hi) & (2 * _MASK + 1)).bit_length()


def _run(number: int, shift: int) -> int:
    return number >> shift if shift < 64 else 0


def _part(number: Column, shift: int) -> Column:
    return F.shiftright(number, shift) if shift < 64 else F.lit(0).cast("long")


def _round(
    keys: DataFrame, cells: dict[int, dict[int, _Cell]], outer: dict[int, int], inner: dict[int, int]
) -> dict[tuple[int, int], _Cell]:
    """The part of its cell that holds each (column, rank); cells are runs of 2^outer numbers, parts of 2^inner."""
    spark = keys.sparkSession
    stacked = [a for f in cells for a in (F.lit(f), _part(F.col(f"_k{f}"), outer[f]), _part(F.col(f"_k{f}"), inner[f]), F.col(f"_k{f}"))]
    rows = keys.select("_w", F.stack(F.lit(len(cells)), *stacked).alias("f", "cell", "part", "k")).filter("k IS NOT NULL")
    ranks = [(f, _run(cell.lo, outer[f]), cell.below, rank) for f, by_rank in cells.items() for rank, cell in by_rank.items()]
    wanted = spark.createDataFrame(ranks, "f int, cell long, below long, rank long")
    # At most one row for each wanted rank.
    open_ = F.broadcast(spark.createDataFrame(sorted({r[:3] for r in ranks}), "f int, cell long, below long"))
    counted = rows.join(open_, ["f", "cell"]).groupBy("f", "cell", "below", "part").agg(
        F.sum("_w").alias("n"), F.min("k").alias("lo"), F.max("k").alias("hi")
    )
    before = Window.partitionBy("f", "cell").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("below") + F.coalesce(F.sum("n").over(before), F.lit(0))
    # A rank lies in the last part that starts at or before it.
    parts = counted.select("f", "cell", start.alias("at"), "lo", "hi").withColumns({"start": F.col("at"), "rank": F.lit(None).cast("long")})
    places = wanted.select("f", "cell", F.col("rank").alias("at"), *[F.lit(None).cast("long").alias(c) for c in ("lo", "hi", "start")], "rank")
    so_far = Window.partitionBy("f", "cell").orderBy("at", F.col("rank").isNotNull()).rowsBetween(Window.unboundedPreceding, 0)
    held = F.last(F.when(F.col("rank").isNull(), F.struct("lo", "hi", "start")), ignorenulls=True).over(so_far)
    found = parts.unionByName(places).withColumn("held", held).filter("rank IS NOT NULL").select("f", "rank", "held.*").collect()
    return {(r["f"], r["rank"]): _Cell(r["lo"], r["hi"], r["start"]) for r in found if r["lo"] is not None}


def order_statistics(
    df: DataFrame, columns: Sequence[Column], ranks: Callable[[int], Sequence[int]], rounds: int | None = None, weight: Column | None = None
) -> list[list[float]]:
    """For each column the values at the 0-based ``ranks(n)`` among its ``n`` values, NULL and NaN left out; -0.0 is given as 0.0.

    The answer does not depend on the partitioning. With ``rounds`` the search stops early, and the smallest value
    of the cell reached stands in for the wanted one. With ``weight``, a whole number, a row stands for so many equal ones (rows
    without weight for none), and ``n`` is the sum of weights. Every round reads ``df``, so hand in a written table.
    """
    if not columns:
        return []
    names = [f"_k{i}" for i in range(len(columns))]
    keys = numbered(df, columns, names, weight)
    count = lambda n: F.coalesce(F.sum(F.when(F.col(n).isNotNull(), F.col("_w"))), F.lit(0))
    ends = keys.agg(*[a for n in names for a in (count(n), F.min(n), F.max(n))]).first()
    wanted = [[r for r in ranks(ends[3 * i]) if r < ends[3 * i]] for i in range(len(names))]
    held = [dict.fromkeys(w, _Cell(ends[3 * i + 1], ends[3 * i + 2], 0)) for i, w in enumerate(wanted)]
    outer = dict.fromkeys(range(len(names)), 64)
    done = 0
    while rounds is None or done < rounds:
        open_ = {f: {r: c for r, c in h.items() if c.lo < c.hi} for f, h in enumerate(held)}
        open_ = {f: h for f, h in open_.items() if h}
        if not open_:
            break
        # A cell's numbers differ in fewer bits than its run is long, so every round narrows each cell.
        inner = {f: max(0, max(c.width for c in h.values()) - DIGIT_BITS) for f, h in open_.items()}
        found = _round(keys, open_, outer, inner)
        for f, by_rank in open_.items():
            for rank in by_rank:
                if (f, rank) not in found:
                    raise RuntimeError("the table has changed while it was searched; hand in a written one")
                held[f][rank] = found[f, rank]
        outer.update(inner)
        done += 1
    return [[_double(held[f][r].lo) for r in w] for f, w in enumerate(wanted)]
