"""Token sequences with as little room left as possible: minimum bin slack.

Documents over the limit are cut into full sequences, their first piece being what is over. The other pieces are dealt out by a hash to groups of
bounded size. A group's sequences are filled one after the other: the longest piece left opens one, a subset-sum search over the lengths still
at hand, in one bitset, finds the set of further pieces that fills it most, and these are removed. The same set is taken again as long as the
group holds it, since with fewer pieces at hand no fuller one can appear; so a group takes at most as many searches as it has lengths.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from copse.llm.packing import Tokenizer
from copse.session import cut

LIMIT = 1_024
END_ID = 2
GROUP_PIECES = 50_000
"""Pieces of one group, about; larger groups leave less room. Memory of a task grows with it."""


def pieces_pass(limit: int, path: str | None):
    end = np.array([END_ID], dtype="<u4").tobytes()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tokenizer = Tokenizer(path)
        for batch in batches:
            rows = []
            for key, text in zip(batch.doc_id, batch.text, strict=True):
                ids = tokenizer.encode(text)[:-4] + end
                n = len(ids) // 4
                # What is over goes to the first piece, so all later ones are full.
                starts = [0, *range((n - 1) % limit + 1, n, limit)]
                ends = [*starts[1:], n]
                rows += [(key, i, a, b - a, ids[4 * a : 4 * b]) for i, (a, b) in enumerate(zip(starts, ends, strict=True))]
            yield pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids"]).astype({"doc_id": "Int64"})

    return run


def pieces(docs: DataFrame, limit: int = LIMIT, doc_id: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """doc_id, piece, start, length, ids of each piece. A NULL text is an empty one: the end id alone."""
    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    return rows.mapInPandas(pieces_pass(limit, path), "doc_id long, piece int, start long, length long, ids binary")


def fullest(counts: dict[int, int], room: int) -> dict[int, int]:
    """How many pieces of each length to take so that their sum is the largest of at most ``room``.

    ``counts`` has the pieces at hand by length. Bit ``s`` of the set says that a sum ``s`` can be had. Lengths are added from long to short, their
    copies in parts of 1, 2, 4, ... and a remainder, until the room can be filled wholly or nothing is left.
    """
    reach, within, steps = 1, (1 << (room + 1)) - 1, []
    for length in sorted((k for k in counts if k <= room), reverse=True):
        left, part = min(counts[length], room // length), 1
        while left:
            take = min(part, left)
            steps.append((reach, length, take))
            reach |= (reach << (length * take)) & within
            left, part = left - take, 2 * part
        if reach >> room:
            break
    goal, taken = reach.bit_length() - 1, {}
    for before, length, take in reversed(steps):
        if not before >> goal & 1:
            goal -= length * take
            taken[length] = taken.get(length, 0) + take
    return taken


def least_slack(lengths: np.ndarray, limit: int = LIMIT) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset of each piece; pieces of one length are taken in the given order."""
    order = np.argsort(-lengths, kind="stable")
    values, starts, sizes = np.unique(-lengths[order], return_index=True, return_counts=True)
    waiting = {int(-v): order[a : a + k] for v, a, k in zip(values, starts, sizes)}
    counts = {length: len(found) for length, found in waiting.items()}
    sequence, offset = np.zeros(len(lengths), dtype=np.int64), np.zeros(len(lengths), dtype=np.int64)
    used = dict.fromkeys(counts, 0)
    bins = 0
    while counts:
        longest = max(counts)
        counts[longest] -= 1
        chosen = fullest({k: n for k, n in counts.items() if n}, limit - longest)
        counts[longest] += 1
        chosen[longest] = chosen.get(longest, 0) + 1
        times = min(counts[k] // n for k, n in chosen.items())
        at, numbers = 0, np.arange(bins, bins + times)
        for length in sorted(chosen, reverse=True):
            for _ in range(chosen[length]):
                rows = waiting[length][used[length] : used[length] + times]
                sequence[rows], offset[rows] = numbers, at
                used[length] += times
                at += length
            counts[length] -= times * chosen[length]
            if not counts[length]:
                del counts[length]
        bins += times
    return sequence, offset


def pack_group(limit: int):
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["doc_id", "piece", "ids_crc32", "row"], kind="stable")
        number, offset = least_slack(rows.length.to_numpy(), limit)
        return rows.drop(columns="row").assign(sequence_id=(np.int64(key[0]) << np.int64(32)) | number, offset=offset)

    return run


def pack(docs: DataFrame, limit: int = LIMIT, doc_id: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """Every piece of every row of ``docs`` with its place: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Sequences have at most ``limit`` tokens and no gaps; a full piece is a sequence of its own. Each row counts, repeated ones too, and one with NULL
    id or text as well: an empty text is the end id alone. Rows are spread over groups by their number, so copies of one row do not meet. An
    empty table has no pieces. Further columns are not read.
    """
    found = pieces(docs, limit, doc_id, text, path)
    columns = ("doc_id", "piece", "start", "length", "ids_crc32")
    found = found.withColumns({"ids_crc32": F.crc32("ids"), "row": F.monotonically_increasing_id()}).select(*columns, "row")
    found = cut(found, "slack-pieces")
    rest = found.filter(F.col("length") < limit)
    groups = max(1, -(-rest.count() // GROUP_PIECES))
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, group long, sequence_id long, offset long"
    grouped = rest.withColumn("group", F.pmod(F.xxhash64("row"), F.lit(groups))).groupBy("group")
    packed = grouped.applyInPandas(pack_group(limit), schema).drop("group")
    # Numbers of full pieces are below zero, so they never meet those of the groups.
    full = found.filter(F.col("length") == limit).withColumns({"sequence_id": -1 - F.col("row"), "offset": F.lit(0).cast("long")})
    return packed.unionByName(full.drop("row"))
