"""Hard negatives for anchors among vectors: near, but less near than a positive.

Scores are integer inner products. Anchors meet all rows block by block: blocks of rows are dealt to stripes, and each block of anchors goes
through every stripe, keeping only what can still be wanted there. A first pass finds the anchors' positives; with these the windows of scores
are known, and a second pass keeps each window's few best rows in every stripe. Their packed keys (anchor, descending score, kind, id) then go
through a secondary sort, and one pass over each sorted partition opens a window at every positive, hands each negative that comes by to
the windows open for it, and closes them when the score falls below. No anchor's rows are gathered anywhere.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from copse.session import cut

POSITIVES = 5
NEGATIVES = 3
CLOSEST, FARTHEST = 95, 50
"""A negative's score is at most and at least this share of the positive's, in hundredths."""
ROW_BLOCK, ANCHOR_BLOCK = 1_024, 256
SCALE = 256
LARGEST = 2**63 - 1
_KEY = ">QQBBQQ"
_EXACT = 2.0**53
_SORT_RECORDS = 200_000
"""Records of one partition of the secondary sort, about."""

_BLOCK = "size int, rows binary, ids binary, no_id binary, labels binary, vectors binary, windows binary"


def usable(vectors: DataFrame) -> DataFrame:
    """row, vec_id, label, vector of the rows that take part, labels as this task changes them."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label").cast("long"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), "label", F.col("embedding").cast("array<double>").alias("vector"), F.monotonically_increasing_id().alias("row")
    )
    return rows.filter(F.col("label").isNotNull() & F.col("vector").isNotNull()).filter(finite).withColumn("label", label)


def _block(rows: pd.DataFrame, window: Callable[[int], tuple[int, int]]) -> tuple:
    """One block: its rows in the order in which equal scores are taken, as bytes."""
    rows = rows.assign(no_id=rows.vec_id.isna(), vec_id=rows.vec_id.fillna(0).astype("int64")).sort_values(["no_id", "vec_id", "row"], kind="stable")
    values = [np.asarray(v, dtype=np.float64) for v in rows.vector]
    table = np.zeros((len(values), max(map(len, values))))
    for line, v in zip(table, values, strict=True):
        line[: len(v)] = v
    with np.errstate(over="ignore"):
        table = np.nan_to_num(np.floor(SCALE * table), posinf=np.finfo(float).max, neginf=np.finfo(float).min)
    windows = [[window(int(s)) for s in scores] for scores in rows.scores] if "scores" in rows else []
    spans = [pair for w in windows for pair in [*w, *[(1, 0)] * (POSITIVES - len(w))]]
    return (
        len(rows), rows.row.to_numpy(np.int64).tobytes(), rows.vec_id.to_numpy(np.int64).tobytes(), rows.no_id.to_numpy(bool).tobytes(),
        rows.label.to_numpy(np.int64).tobytes(), table.tobytes(), np.array(spans, dtype=np.int64).tobytes(),
    )


def window_of(score: int) -> tuple[int, int]:
    """Least and greatest score of a negative beside a positive of this score; an empty range below zero."""
    return -(-FARTHEST * score // 100), CLOSEST * score // 100


def _blocks_pass(size: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        count = 0
        for batch in batches:
            held.append(batch)
            count += len(batch)
            if count >= size:
                rows = pd.concat(held)
                full = count // size * size
                yield pd.DataFrame([_block(rows[at : at + size], window_of) for at in range(0, full, size)], columns=_NAMES)
                held, count = [rows[full:]], count - full
        if count:
            yield pd.DataFrame([_block(pd.concat(held), window_of)], columns=_NAMES)

    return run


_NAMES = [part.split()[0] for part in _BLOCK.split(", ")]


def blocks(rows: DataFrame, size: int, name: str) -> DataFrame:
    """``rows`` (with an array ``scores`` of their positives, for anchors that have these) as numbered blocks of at most ``size`` rows, written."""
    wanted = ["row", "vec_id", "label", "vector", *[c for c in rows.columns if c == "scores"]]
    made = rows.select(*wanted).mapInPandas(_blocks_pass(size), _BLOCK)
    return cut(made.withColumn("block", F.monotonically_increasing_id()), name)


def inner(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All inner products of whole-numbered rows, exact; beyond a long they are the greatest or least one. A shorter vector goes on with zeros."""
    width = min(a.shape[1], b.shape[1])
    a, b = a[:, :width], b[:, :width]
    if not width:
        return np.zeros((len(a), len(b)), dtype=np.int64)
    most_a, most_b = np.abs(a).max(axis=1), np.abs(b).max(axis=1)
    if most_a.max() * most_b.max() * width < _EXACT:
        return (a @ b.T).astype(np.int64)
    with np.errstate(all="ignore"):
        out = np.nan_to_num(a @ b.T, nan=0.0, posinf=0.0, neginf=0.0)
        large = most_a[:, None] * most_b[None, :] * width >= _EXACT
        out = np.where(large, 0.0, out).astype(np.int64)
    whole_a, whole_b = {}, {}
    for i, j in zip(*np.nonzero(large)):
        x = whole_a.setdefault(i, [int(v) for v in a[i]])
        y = whole_b.setdefault(j, [int(v) for v in b[j]])
        out[i, j] = max(-LARGEST, min(LARGEST, sum(p * q for p, q in zip(x, y))))
    return out


def leading(scores: np.ndarray, allowed: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Line and column of the ``k`` highest allowed scores of each line; of equal ones the first columns."""
    keep = allowed
    if scores.shape[1] > k:
        held = np.where(allowed, scores, -LARGEST - 1)
        keep = allowed & (scores >= np.partition(held, -k, axis=1)[:, -k][:, None])
    line, column = np.nonzero(keep)
    order = np.lexsort((column, -scores[line, column], line))
    line, column = line[order], column[order]
    first = np.arange(len(line)) - np.searchsorted(line, line) < k
    return line[first], column[first]


class _Side:
    """A block read back."""

    def __init__(self, record: dict, prefix: str):
        def numbers(name: str, kind=np.int64) -> np.ndarray:
            return np.frombuffer(record[prefix + name], dtype=kind)

        n = record[prefix + "size"]
        self.rows, self.ids, self.labels = numbers("rows"), numbers("ids"), numbers("labels")
        self.no_id, self.vectors = numbers("no_id", bool), numbers("vectors", np.float64).reshape(n, -1)
        self.windows = numbers("windows").reshape(-1, POSITIVES, 2)


def _same_label(anchors: _Side, rows: _Side) -> np.ndarray:
    return anchors.labels[:, None] == rows.labels[None, :]


def positives_of(anchors: _Side, rows: _Side) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    scores = inner(anchors.vectors, rows.vectors)
    line, column = leading(scores, _same_label(anchors, rows) & (anchors.rows[:, None] != rows.rows[None, :]), POSITIVES)
    return line, column, scores[line, column]


def negatives_of(anchors: _Side, rows: _Side) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """As ``positives_of``, with a line for each anchor and window."""
    scores, other = inner(anchors.vectors, rows.vectors), ~_same_label(anchors, rows)
    found = []
    for j in range(POSITIVES):
        low, high = anchors.windows[:, j, 0][:, None], anchors.windows[:, j, 1][:, None]
        line, column = leading(scores, other & (scores >= low) & (scores <= high), NEGATIVES)
        found.append((line * POSITIVES + j, column, scores[line, column]))
    return tuple(np.concatenate(x) for x in zip(*found))


_FOUND = "anchor long, score long, kind int, no_id int, id long, row long"


def _scan_pass(find: Callable, k: int, lines: int, kind: int):
    """Go through pairs of an anchor block and a row block, keeping the ``k`` best of each line as long as the anchor block stays the same."""

    def best(parts: list[np.ndarray]) -> np.ndarray:
        rows = np.concatenate(parts, axis=1)
        rows = rows[:, np.lexsort((rows[4], rows[3], rows[2], -rows[1], rows[0]))]
        return rows[:, np.arange(rows.shape[1]) - np.searchsorted(rows[0], rows[0]) < k]

    def told(anchors: _Side, rows: np.ndarray) -> pd.DataFrame:
        anchor = anchors.rows[rows[0] // lines]
        table = pd.DataFrame({"anchor": anchor, "score": rows[1], "kind": kind, "no_id": rows[2], "id": rows[3], "row": rows[4]})
        return table.drop_duplicates(["anchor", "row"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, anchors, held = None, None, np.zeros((5, 0), dtype=np.int64)
        for batch in batches:
            for record in batch.to_dict("records"):
                if record["a_block"] != now:
                    if held.shape[1]:
                        yield told(anchors, held)
                    now, anchors, held = record["a_block"], _Side(record, "a_"), held[:, :0]
                rows = _Side(record, "r_")
                line, column, score = find(anchors, rows)
                held = best([held, np.stack([line, score, rows.no_id[column], rows.ids[column], rows.rows[column]])])
        if held.shape[1]:
            yield told(anchors, held)

    return run


def _scanned(anchors: DataFrame, rows: DataFrame, run: Callable, stripes: int) -> DataFrame:
    number = F.shiftright("r_block", 33) + F.col("r_block").bitwiseAND((1 << 33) - 1)
    left = anchors.select(*[F.col(c).alias(f"a_{c}") for c in anchors.columns]).withColumn("stripe", F.explode(F.sequence(F.lit(0), F.lit(stripes - 1))))
    right = rows.select(*[F.col(c).alias(f"r_{c}") for c in rows.columns]).withColumn("stripe", F.pmod(number, F.lit(stripes)).cast("int"))
    pairs = left.repartition(2 * stripes, "stripe").join(right.repartition(2 * stripes, "stripe"), "stripe")
    return pairs.mapInPandas(run, _FOUND)


def packed(record) -> tuple[bytes, int | None]:
    """The key by which a record is sorted: anchor, falling score, positives before negatives, rising id with NULL last."""
    return struct.pack(_KEY, record.anchor, LARGEST - record.score, record.kind, record.no_id, record.id + 2**63, record.row), record.anchor_id


def part_of(key: bytes) -> int:
    return zlib.crc32(key[:8])


def mined(records: Iterator[tuple[bytes, int | None]], negatives: int = NEGATIVES) -> Iterator[tuple]:
    """Negatives for the positives of each anchor, in one pass over sorted records; holds the open windows of one anchor only."""
    now, anchor_id, open_ = None, None, []
    for key, own_id in records:
        anchor, down, kind, no_id, shifted, _ = struct.unpack(_KEY, key)
        if anchor != now:
            now, anchor_id, open_ = anchor, None, []
        score, other = LARGEST - down, None if no_id else shifted - 2**63
        if not kind:
            anchor_id = own_id
            open_.append([other, score, 0])
            continue
        # Scores only fall from here on: what is closed for this one stays closed.
        open_ = [w for w in open_ if FARTHEST * w[1] <= 100 * score and w[2] < negatives]
        for w in open_:
            if 100 * score <= CLOSEST * w[1]:
                w[2] += 1
                yield anchor_id, w[0], w[2], other, w[1], score


def mine(vectors: DataFrame, anchor: Column | None = None) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score for the anchors (vec_id divisible by 50) among ``vectors``.

    ``vectors`` has vec_id, label, embedding; further columns are not read. Rows with a NULL label or vector, or with a component that is NULL, NaN or
    infinite, take no part. A row without id is no anchor, keeps its label, and comes after those with equal score; repeated rows each count, as
    anchors as well as partners, and of equal ids the row read first comes first. An empty vector scores 0, one shorter than
    its partner goes on with zeros, and scores beyond a long are the greatest or least long. An empty table has no rows here either.
    """
    spark = vectors.sparkSession
    rows = cut(usable(vectors), "vectors")
    anchors = rows.filter(F.col("vec_id") % 50 == 0 if anchor is None else anchor)
    row_blocks = blocks(rows, ROW_BLOCK, "row-blocks")
    cores = spark.sparkContext.defaultParallelism
    stripes = max(1, min(row_blocks.count(), 4 * cores))
    near = _scanned(blocks(anchors, ANCHOR_BLOCK, "anchor-blocks"), row_blocks, _scan_pass(positives_of, POSITIVES, 1, 0), stripes)
    # At most POSITIVES rows of each stripe meet here.
    order = F.struct((-F.col("score")).alias("down"), "no_id", "id", "row")
    near = near.groupBy("anchor").agg(F.slice(F.array_sort(F.collect_list(order)), 1, POSITIVES).alias("near"))
    with_near = cut(anchors.join(near, F.col("row") == F.col("anchor")), "positives").withColumn("scores", F.transform("near", lambda x: -x["down"]))
    far = _scanned(blocks(with_near, ANCHOR_BLOCK, "window-blocks"), row_blocks, _scan_pass(negatives_of, NEGATIVES, POSITIVES, 1), stripes)
    own = with_near.select(F.col("vec_id").alias("anchor_id"), "anchor", F.explode("near").alias("x")).select(
        "anchor", (-F.col("x.down")).alias("score"), F.lit(0).alias("kind"), "x.no_id", "x.id", "x.row", "anchor_id"
    )
    records = cut(own.unionByName(far.withColumn("anchor_id", F.lit(None).cast("long"))), "scored")
    parts = max(cores, -(-records.count() // _SORT_RECORDS))
    sorted_ = records.rdd.map(packed).repartitionAndSortWithinPartitions(parts, part_of)
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    return spark.createDataFrame(sorted_.mapPartitions(partial(mined, negatives=NEGATIVES)), schema, verifySchema=False)
