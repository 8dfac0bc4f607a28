"""Balancing classes with interpolated rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut, skew_join
from .neighbors import knn
from .rank import draw_key, ranked, train_test_split


def _hex(text, start: int, length: int):
    return F.conv(F.substring(text, start, length), 16, 10)


def synthetic_rows(
    df: DataFrame, row_id: str, label: str, features: Sequence[str], k: int = 5, seed: int = 42
) -> DataFrame:
    """New rows that bring every class to the size of the largest. Labels must be whole numbers; NULL is no class.

    Row ``i`` of a class takes a member and the rank of one of its ``k``
    nearest members from the hash of ``i`` and the seed, and a point between
    the two. Members are addressed by their place in draw order, so drawing is
    an equi-join on evenly spread keys. Synthetic ids count down from -1.
    """
    y = F.col(label)
    stats = df.groupBy(y.cast("double").alias("y")).agg(F.count("*").alias("n")).collect()
    # NULL labels are no class: they neither set the target size nor get synthetic rows.
    counts = {r["y"]: r["n"] for r in stats if r["y"] is not None}
    if any(v != int(v) for v in counts):
        raise ValueError(f"labels in {label} must be whole numbers")
    counts = {int(v): n for v, n in counts.items()}
    largest = max(counts.values(), default=0)
    short = sorted(v for v, n in counts.items() if n < largest)
    kinds = ", ".join(f"`{c}` double" for c in features)
    if not short:
        return df.sparkSession.createDataFrame([], f"`{row_id}` bigint, `{label}` int, {kinds}")
    for v in short:
        if counts[v] < 2:
            raise ValueError(f"class {v} has a single row and so no neighbour")
    # Inside, all names are reserved ones, so the caller's may be any.
    members = df.filter(y.isin(short)).select(
        F.col(row_id).cast("long").alias("_id"),
        y.cast("int").alias("_cls"),
        F.array(*[F.col(c).cast("double") for c in features]).alias("_x"),
    )
    members = cut(members, "members")
    placed = ranked(members, [F.col("_cls"), draw_key("_id", seed), F.col("_id")], "_rank")
    draws, first, made = [], 0, 0
    for v in short:
        n, new = counts[v], largest - counts[v]
        ways = min(k, n - 1)
        h = F.md5(F.concat(F.col("id").cast("string"), F.lit(f":{v}:{seed}")))
        pick = F.pmod(_hex(h, 1, 15).cast("long"), F.lit(n * ways))
        draws.append(
            df.sparkSession.range(new).select(
                (-1 - made - F.col("id")).alias("_new"),
                F.lit(v).cast("int").alias("_cls"),
                (F.floor(pick / ways) + first + 1).alias("_rank"),
                (F.pmod(pick, F.lit(ways)) + 1).cast("int").alias("_nn_rank"),
                (_hex(h, 16, 13).cast("double") / float(1 << 52)).alias("_u"),
            )
        )
        first, made = first + n, made + new
    drawn = reduce(DataFrame.unionByName, draws)
    near = knn(members, "_id", "_cls", "_x", k).select(
        F.col("row_id").alias("_id"), F.col("rank").alias("_nn_rank"), F.col("nn_id").alias("_nn_id")
    )
    started = drawn.join(placed.select("_rank", "_id", "_x"), "_rank").join(near, ["_id", "_nn_rank"])
    # Many rows may share a neighbour, copies above all; draws repeat their shares.
    ends = members.select(F.col("_id").alias("_nn_id"), F.col("_x").alias("_nn_x"))
    paired = skew_join(started, ends, ["_nn_id"], "_new", counted=near)
    mixed = paired.withColumn("_z", F.zip_with("_x", "_nn_x", lambda a, b: a + F.col("_u") * (b - a)))
    return mixed.select(
        F.col("_new").alias(row_id), F.col("_cls").alias(label),
        *[F.get("_z", F.lit(i)).alias(c) for i, c in enumerate(features)],
    )


def oversample(
    df: DataFrame, row_id: str, label: str, features: Sequence[str], k: int = 5, seed: int = 42
) -> DataFrame:
    """The rows themselves plus the synthetic ones, told apart by ``synthetic``."""
    own = df.select(
        F.col(row_id).cast("long").alias(row_id),
        F.col(label).cast("int").alias(label),
        *[F.col(c).cast("double").alias(c) for c in features],
    )
    new = synthetic_rows(df, row_id, label, features, k, seed)
    return own.withColumn("synthetic", F.lit(False)).unionByName(new.withColumn("synthetic", F.lit(True)))


def split_and_oversample(
    df: DataFrame,
    row_id: str,
    label: str,
    features: Sequence[str],
    test_size: float = 0.2,
    k: int = 5,
    seed: int = 42,
) -> DataFrame:
    """Balance the training part only and put the untouched test rows back, marked by ``part``."""
    split = train_test_split(df, row_id, test_size, seed)
    train = oversample(split.filter(F.col("part") == "train"), row_id, label, features, k, seed)
    test = split.filter(F.col("part") == "test").select(
        F.col(row_id).cast("long").alias(row_id),
        F.col(label).cast("int").alias(label),
        *[F.col(c).cast("double").alias(c) for c in features],
        F.lit(False).alias("synthetic"),
    )
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))
