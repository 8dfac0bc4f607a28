"""Consistent placement of keys on shards through a permutation-filled lookup table.

Each shard has a preference order over the slots of a table of prime size (an offset and a step of its own). The shards
take turns; each claims the first slot of its order that is still free, until the table is full. So every shard owns the
same number of slots to within its turn, and a shard that comes or goes moves little beyond its own share. A key's slot is its
hash modulo the table size; the table (``slots`` rows of two integers, about a megabyte) is broadcast.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SLOTS = 65_537
"""Default table size, a prime; at least a hundred slots for each shard keep the shares even."""

MAX_SLOTS = 1_000_003
"""Larger tables are refused: the table is broadcast, and this bounds it at some 16 MB."""


def _is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n**0.5) + 1))


def lookup_table(shards: list[str], slots: int = SLOTS) -> np.ndarray:
    """The index in ``shards`` that owns each slot.

    The names must be unique and not empty, and there may be no more of them than slots. The table depends on the set of
    names alone: turns are taken in the order of the names.
    """
    if not shards or len(set(shards)) != len(shards):
        raise ValueError("shard names must be unique, and there must be at least one")
    if not _is_prime(slots) or not len(shards) <= slots <= MAX_SLOTS:
        raise ValueError(f"slots must be a prime from the number of shards up to {MAX_SLOTS}")
    order = sorted(range(len(shards)), key=lambda i: shards[i])
    place, step = {}, {}
    for i in order:
        digest = hashlib.md5(shards[i].encode()).digest()
        place[i] = int.from_bytes(digest[:8], "big") % slots
        step[i] = int.from_bytes(digest[8:], "big") % (slots - 1) + 1
    table, free = np.full(slots, -1, dtype=np.int32), slots
    while True:
        for i in order:
            while table[place[i]] >= 0:
                place[i] = (place[i] + step[i]) % slots
            table[place[i]] = i
            free -= 1
            if not free:
                return table


def slot_of(*keys: Column, slots: int = SLOTS) -> Column:
    """The slot of a key of one or more columns. NULL is a key like any other."""
    text = [F.coalesce(F.concat(F.lit("="), k.cast("string")), F.lit("-")) for k in keys]
    return F.pmod(F.xxhash64(*text), F.lit(slots)).cast("int")


def place(df: DataFrame, keys: list[str], shards: list[str], slots: int = SLOTS, out: str = "shard") -> DataFrame:
    """``df`` with the shard of each row in column ``out``, added without a shuffle.

    All rows stay, repeated ones and those with NULL keys included, and equal keys get the same shard. An empty frame gives an
    empty one. A column called ``out`` is replaced. A hot key goes to one shard whole; where that matters, add a column
    that tells its rows apart to ``keys``.
    """
    spark = df.sparkSession
    owners = [(slot, shards[i]) for slot, i in enumerate(lookup_table(shards, slots).tolist())]
    table = spark.createDataFrame(owners, "slot int, owner string")
    # A row is carried as one value, so its columns may have any names.
    kept = [c for c in df.columns if c != out]
    whole = F.struct(*[F.col(f"`{c}`") for c in kept], F.lit(0)).alias("row")
    rows = df.select(whole, slot_of(*(F.col(f"`{k}`") for k in keys), slots=slots).alias("slot"))
    placed = rows.join(F.broadcast(table), "slot")
    return placed.select(*[F.col("row").getField(c).alias(c) for c in kept], F.col("owner").alias(out))


def write_shards(df: DataFrame, path: str, column: str = "shard", files: int = 1) -> None:
    """Write one folder for each shard, each in up to ``files`` files; rows are dealt out over these by a hash of all columns."""
    salt = F.pmod(F.xxhash64(*(F.col(f"`{c}`") for c in df.columns)), F.lit(files))
    df.repartition(F.col(f"`{column}`"), salt).write.partitionBy(column).parquet(path)
