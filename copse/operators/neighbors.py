"""Exact nearest neighbours within a class, without comparing all pairs.

Points are assigned to the nearest of a few pivots. By the triangle inequality
a cell's points have their k nearest neighbours within a known radius, so each
point asks only the cells that may hold nearer ones (a k-nearest-neighbour join
over a Voronoi partition, as published for MapReduce): first its own, which gives
the radius it then asks the others with. Large cells are cut into parts, and only
the best k of each leave a task. Where the bound rules out little, as with many
dimensions, points are not sent about: all are compared in blocks as they are read.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext, cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import cut, cut_to, new_folder, remove_folder, skew_join

# Send the functions of this module to tasks by value, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

CHUNK = 16_384  # points of a cell that are compared in one task
CHUNK_NUMBERS = 1 << 21  # in the vectors of these
FRAME_NUMBERS = 1 << 18  # in the vectors and ids of a frame that a task hands on
MAX_PIVOTS = 2048  # per class; with the width of a vector this bounds what tasks are sent
CELL_NUMBERS = 64  # points a cell, for each dimension: with few of them small cells leave few pairs, with many a point goes to most cells
TASK_POINTS = 20_000
STEP_NUMBERS = 1 << 20  # distances that a task holds at once
SHORT_WIDTH, SHORT_MOST = 16, 1e30  # numbers of a vector, and squares, for which single precision may do
PAIRS = 1 << 16  # pairs that are measured exactly at a time
ASKS = 4  # cells that a point of a class may ask on average, whatever their number
FAR_SHARE = 1 / 8  # of its cells; a class whose points ask more is compared as a whole
PROBED = 16  # cells of a class that are looked into before it is decided
ASKED_AT_ONCE = 1 << 16  # points that one part of a cell answers in one task
BLOCK_NUMBERS = 1 << 18  # in the vectors of a block, where all pairs are compared
FILE_BLOCKS = 8  # in a file; a task compares those of one file
RUN_BYTES = 64 << 20  # of the blocks that a task holds to compare its own with
NO_ID = np.iinfo(np.int64).max

INSIDE = (
    "cls int, vid bigint, ids array<bigint>, vec array<double>, cell int, part int, dists array<double>, nids array<bigint>, within double, asks bigint"
)
BLOCK = "cls int, at bigint, block binary"
LISTS = "cls int, vid bigint, ids array<bigint>, vec array<double>, dists array<double>, nids array<bigint>"


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances of all rows of ``a`` to all rows of ``b``."""
    out = np.empty((len(a), len(b)))
    step = max(1, 4_000_000 // max(1, b.size))
    for at in range(0, len(a), step):
        diff = a[at : at + step, None, :] - b[None, :, :]
        out[at : at + step] = np.sqrt(np.einsum("ijk,ijk->ij", diff, diff))
    return out


def _pivots(points: DataFrame, chunk: int) -> tuple[dict, int]:
    """Per class a hash-drawn sample of its distinct vectors; and the number of points in all."""
    sizes = {r["cls"]: r["n"] for r in points.groupBy("cls").agg(F.count("*").alias("n")).collect()}
    order = Window.partitionBy("cls").orderBy(F.xxhash64("vec"), "vid")
    drawn = points.withColumn("r", F.row_number().over(order)).filter(F.col("r") <= MAX_PIVOTS)
    rows = drawn.orderBy("cls", "r").select("cls", "vec").collect()
    out: dict = {}
    for r in rows:
        wanted = min(MAX_PIVOTS, math.ceil(sizes[r["cls"]] / min(chunk, CELL_NUMBERS * max(1, len(r["vec"])))))
        kept = out.setdefault(r["cls"], [])
        if len(kept) < wanted:
            kept.append(r["vec"])
    return {c: np.array(v, dtype=float) for c, v in out.items()}, sum(sizes.values())


def _assign(pivots: dict):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch = batch.assign(cell=0, dist=0.0)
            for cls, part in batch.groupby("cls"):
                vectors = np.stack(part["vec"].to_numpy()).astype(float)
                if np.isnan(vectors).any():
                    raise ValueError("a feature is missing; impute or drop such rows first")
                nearest, dist = np.empty(len(vectors), dtype=np.int64), np.empty(len(vectors))
                step = max(1, STEP_NUMBERS // len(pivots[cls]))
                for at in range(0, len(vectors), step):
                    d = _distances(vectors[at : at + step], pivots[cls])
                    nearest[at : at + step] = d.argmin(axis=1)
                    dist[at : at + step] = d.min(axis=1)
                batch.loc[part.index, "cell"] = nearest
                batch.loc[part.index, "dist"] = dist
            yield batch

    return run


def _reach(pivots: dict, stats, k: int) -> dict:
    """Per class: cell radii, and a radius that holds k+1 points around each of a cell's points."""
    radius = {c: np.full(len(p), -np.inf) for c, p in pivots.items()}
    near = {c: np.full((len(p), k + 1), np.inf) for c, p in pivots.items()}
    for r in stats:
        radius[r["cls"]][r["cell"]] = r["radius"]
        near[r["cls"]][r["cell"], r["r"] - 1] = r["dist"]
    out = {}
    for c, p in pivots.items():
        between = _distances(p, p)
        bound = np.full(len(p), np.inf)
        for i in range(len(p)):
            if np.isfinite(radius[c][i]):
                # Infinite where the class has too few points.
                bound[i] = np.partition((radius[c][i] + between[i][:, None] + near[c]).ravel(), k)[k]
        out[c] = (radius[c], bound, between)
    return out


def _steps(batch: pd.DataFrame, pivots: dict) -> Iterator[tuple]:
    """The points of each class in runs of bounded size."""
    for cls, part in batch.groupby("cls"):
        step = max(1, STEP_NUMBERS // len(pivots[cls]))
        for at in range(0, len(part), step):
            yield cls, part.iloc[at : at + step]


def _send(pivots: dict, reach: dict):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for cls, part in _steps(batch, pivots):
                radius, bound, between = reach[cls]
                d = _distances(np.stack(part["vec"].to_numpy()), pivots[cls])
                own = part["cell"].to_numpy()
                mine = d[np.arange(len(d)), own][:, None]
                more = [c for c in ("within", "own", "part") if c in part]
                limit = part["within"].to_numpy()[:, None] if more else bound[None, :]
                wanted = _wanted(d, mine, radius, between[own], limit)
                who, cell = np.nonzero(wanted)
                # With many dimensions a point goes to most cells: a batch then makes far more rows than it holds.
                width = sum(len(x) for x in part["ids"]) / len(part) + len(part["vec"].iloc[0])
                step = max(1, int(FRAME_NUMBERS // width))
                for at in range(0, len(who), step):
                    yield part.iloc[who[at : at + step]][["cls", "vid", "ids", "vec", *more]].assign(cell=cell[at : at + step])

    return run


def _vectors(column: pa.ChunkedArray) -> np.ndarray:
    """A column of lists of one length as the rows of an array."""
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    numbers = lists.flatten().to_numpy(zero_copy_only=False)
    return numbers.reshape(len(lists), -1).astype(float, copy=False)


class _Ids:
    """The ids that share each vector, smallest first."""

    def __init__(self, flat: np.ndarray, sizes: np.ndarray):
        self.flat, self.sizes = flat, sizes
        self.first = np.r_[0, np.cumsum(sizes)][:-1]

    @classmethod
    def of(cls, column: pa.ChunkedArray) -> _Ids:
        lists = column.combine_chunks()
        return cls(lists.flatten().to_numpy(zero_copy_only=False), lists.value_lengths().to_numpy(zero_copy_only=False))

    def spread(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the vectors ``at``, and the place in ``at`` that each belongs to."""
        sizes = self.sizes[at]
        place = np.repeat(np.arange(len(at)), sizes)
        within = np.arange(len(place)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        return self.flat[self.first[at][place] + within], place


class _Lists:
    """Of each point the ``keep`` nearest ids found so far by distance and id, own copies included; places not taken hold NO_ID."""

    def __init__(self, size: int, keep: int, dist: np.ndarray | None = None, ids: np.ndarray | None = None):
        self.dist = np.full((size, keep), np.inf) if dist is None else dist
        self.ids = np.full((size, keep), NO_ID) if ids is None else ids

    def add(self, at: int, row: np.ndarray, dist: np.ndarray, ids: np.ndarray) -> None:
        """Take pairs in; ``row`` counts from the point ``at``."""
        touched, row = np.unique(row, return_inverse=True)
        keep, own = self.dist.shape[1], at + touched
        row = np.r_[np.repeat(np.arange(len(touched)), keep), row]
        dist, ids = np.r_[self.dist[own].ravel(), dist], np.r_[self.ids[own].ravel(), ids]
        order = np.lexsort((ids, dist, row))
        row = row[order]
        first = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
        order = order[(first[:, None] + np.arange(keep)).ravel()]  # each point has ``keep`` places at least
        self.dist[own], self.ids[own] = dist[order].reshape(-1, keep), ids[order].reshape(-1, keep)

    def columns(self) -> tuple[pa.Array, pa.Array]:
        taken = self.ids != NO_ID
        ends = pa.array(np.r_[0, np.cumsum(taken.sum(axis=1))], pa.int32())
        return pa.ListArray.from_arrays(ends, pa.array(self.dist[taken])), pa.ListArray.from_arrays(ends, pa.array(self.ids[taken]))


def _search(lists: _Lists, vectors: np.ndarray, others: np.ndarray, ids: _Ids, limit: np.ndarray | None = None) -> None:
    """Take into ``lists`` of ``vectors`` whatever of ``others`` belongs there, and is no farther than ``limit``.

    A matrix product gives the squared distances up to rounding; what may be among the nearest within twice that error is measured exactly.
    """
    keep, width = lists.dist.shape[1], vectors.shape[1]
    centre = others.mean(axis=0)
    with np.errstate(all="ignore"):
        a, b = vectors - centre, others - centre
        aa, bb = np.einsum("ij,ij->i", a, a), np.einsum("ij,ij->i", b, b)
    plain = np.isfinite(aa).all() and np.isfinite(bb).all()
    if plain:
        # |b|^2 - 2ab as one product. Few bits are enough for many numbers, unless they leave too many pairs open.
        left, right = np.c_[a, np.ones(len(a))], np.c_[-2.0 * b, bb].T
        wide = {float: (left, right)}
        if width >= SHORT_WIDTH and max(aa.max(), bb.max()) < SHORT_MOST:
            wide = {np.float32: (left.astype(np.float32), right.astype(np.float32)), **wide}
    step = max(1, STEP_NUMBERS // len(others))
    for at in range(0, len(vectors), step):
        end = at + step
        most = lists.dist[at:end, -1] if limit is None else np.minimum(lists.dist[at:end, -1], limit[at:end])
        ranked = len(others) > keep and not np.isfinite(most).all()
        if not plain:
            d = _distances(vectors[at:end], others)
            bound = np.minimum(most, np.partition(d, keep - 1, axis=1)[:, keep - 1]) if ranked else most
            row, col = np.nonzero(d <= bound[:, None])
        for kind, (x, y) in list(wide.items()) if plain else ():
            d = x[at:end] @ y
            error = 4 * (width + 8) * float(np.finfo(kind).eps) * (aa[at:end] + bb.max())
            bound = most * most - aa[at:end] + error
            if ranked:
                bound = np.minimum(bound, np.partition(d, keep - 1, axis=1)[:, keep - 1] + 2 * error)
            if kind is not float:
                bound = np.nextafter(bound.astype(kind), kind(np.inf))
            row, col = np.nonzero(d <= bound[:, None])
            if len(row) <= 16 * keep * len(d):
                break
            if kind is not float:
                del wide[kind]
        for some in range(0, len(row), PAIRS):
            r, c = row[some : some + PAIRS], col[some : some + PAIRS]
            diff = vectors[at + r] - others[c]
            found, place = ids.spread(c)
            lists.add(at, r[place], np.sqrt(np.einsum("ij,ij->i", diff, diff))[place], found)


def _asked(vectors: np.ndarray, own: int, limit: np.ndarray, pivots: np.ndarray, reach: tuple) -> np.ndarray:
    """How many other cells may hold points within ``limit`` of each point of a cell."""
    radius, _, between = reach
    mine = _distances(vectors, pivots[own : own + 1])
    # By the triangle inequality the plane towards a far pivot is beyond the limit of all of these points.
    near = np.flatnonzero((between[own] / 2 <= (mine[:, 0] + limit).max() * (1 + 1e-9) + 1e-9) & np.isfinite(radius))
    out = np.zeros(len(vectors), dtype=np.int64)
    step = max(1, STEP_NUMBERS // max(1, len(near)))
    for at in range(0, len(vectors), step):
        d = _distances(vectors[at : at + step], pivots[near])
        wanted = _wanted(d, mine[at : at + step], radius[near], between[own, near], limit[at : at + step, None])
        out[at : at + step] = (wanted & (near != own)[None, :]).sum(axis=1)
    return out


def _wanted(d: np.ndarray, mine: np.ndarray, radius: np.ndarray, between: np.ndarray, limit: np.ndarray) -> np.ndarray:
    """Whether points at distances ``d`` from the pivots may have others of these cells within ``limit``."""
    with np.errstate(divide="ignore", invalid="ignore"):
        plane = np.nan_to_num((d * d - mine * mine) / (2 * between), nan=0.0, posinf=0.0, neginf=0.0)
    least = np.maximum(d - radius[None, :], plane)
    slack = 1e-9 * (1.0 + np.abs(d))
    return (least <= limit + slack) & np.isfinite(radius)[None, :]


def _inside(pivots: dict, reach: dict, k: int):
    """The nearest points of each point in its own part of a cell, and how many cells it must ask for nearer ones."""

    def run(rows: pa.Table) -> pa.Table:
        cls, cell, parts = (rows.column(c)[0].as_py() for c in ("cls", "cell", "parts"))
        vectors = _vectors(rows.column("vec"))
        lists = _Lists(len(vectors), k + 1)
        _search(lists, vectors, vectors, _Ids.of(rows.column("ids")))
        limit = np.minimum(lists.dist[:, -1], reach[cls][1][cell])
        asks = _asked(vectors, cell, limit, pivots[cls], reach[cls]) + (parts - 1)
        near = lists.columns()
        kept = rows.select(["cls", "vid", "ids", "vec", "cell", "part"])
        for name, c in (("dists", near[0]), ("nids", near[1]), ("within", pa.array(limit)), ("asks", pa.array(asks))):
            kept = kept.append_column(name, c)
        return kept

    return run


def _nearest(k: int):
    """The nearest points of a part of a cell to those that ask it."""

    def run(queries: pa.Table, candidates: pa.Table) -> pa.Table:
        lists = _Lists(queries.num_rows, k + 1)
        if queries.num_rows and candidates.num_rows:
            vectors = _vectors(queries.column("vec"))
            _search(lists, vectors, _vectors(candidates.column("vec")), _Ids.of(candidates.column("ids")), queries.column("within").to_numpy())
        near = lists.columns()
        kind = pa.schema([("cls", pa.int32()), ("vid", pa.int64()), ("dists", pa.list_(pa.float64())), ("nids", pa.list_(pa.int64()))])
        columns = [queries.column(c) if queries.num_rows else pa.array([]) for c in ("cls", "vid")]
        return pa.table([c.cast(t) for c, t in zip((*columns, *near), kind.types)], schema=kind)

    return run


# --- all pairs, in blocks ------------------------------------------------------------


def _packed(vectors: np.ndarray, ids: _Ids, lists: _Lists) -> bytes:
    short = vectors.astype(np.float32)
    kind = short if np.array_equal(short, vectors) else vectors  # without loss
    head = np.array([*vectors.shape, len(ids.flat), lists.dist.shape[1], kind.itemsize], dtype=np.int64)
    arrays = (head, ids.flat.astype(np.int64), ids.sizes.astype(np.int64), lists.dist, lists.ids, kind)
    return b"".join(np.ascontiguousarray(x).tobytes() for x in arrays)


def _unpacked(block) -> tuple[np.ndarray, _Ids, _Lists]:
    size, width, flat, keep, kind = np.frombuffer(block, dtype=np.int64, count=5).tolist()
    ends = np.cumsum([5, flat, size, size * keep, size * keep])
    data = np.frombuffer(block, dtype=np.int64, count=ends[-1])
    own, sizes, dist, ids = (data[i:j] for i, j in zip(ends, ends[1:]))
    vectors = np.frombuffer(block, dtype=f"f{kind}", offset=8 * int(ends[-1])).reshape(size, width).astype(float)
    return vectors, _Ids(own, sizes), _Lists(size, keep, dist.view(float).reshape(size, keep).copy(), ids.reshape(size, keep).copy())


def _block(cls: int, at: int, block: bytes) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([cls], pa.int32()), pa.array([at], pa.int64()), pa.array([block], pa.binary())], ["cls", "at", "block"])


def _pack(k: int):
    """Points as numbered blocks of bounded size, with empty lists."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 33
        for batch in batches:
            for cls in pc.unique(batch.column("cls")):
                rows = pa.table(batch.filter(pc.equal(batch.column("cls"), cls)))
                vectors = _vectors(rows.column("vec"))
                step = max(1, BLOCK_NUMBERS // max(1, vectors.shape[1]))
                for at in range(0, len(vectors), step):
                    some = rows.slice(at, step)
                    yield _block(cls.as_py(), number, _packed(vectors[at : at + step], _Ids.of(some.column("ids")), _Lists(len(some), k + 1)))
                    number += 1

    return run


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks with what a run of other blocks adds to their lists; the pairs of a block come one after the other."""
    held = None
    for batch in batches:
        for i in range(batch.num_rows):
            at, cls = batch.column("at")[i].as_py(), batch.column("cls")[i].as_py()
            if held is None or held[1] != at:
                if held:
                    yield _block(*held[:2], _packed(*held[2:]))
                held = (cls, at, *_unpacked(batch.column("block")[i].as_buffer()))
            if batch.column("other")[i].is_valid:
                others, ids, _ = _unpacked(batch.column("other")[i].as_buffer())
                _search(held[4], held[2], others, ids)
    if held:
        yield _block(*held[:2], _packed(*held[2:]))


def _lists_of(k: int):
    """The lists of all points of blocks; the vector only of points with more copies than ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                vectors, ids, lists = _unpacked(batch.column("block")[i].as_buffer())
                cls = pa.array(np.full(len(ids.first), batch.column("cls")[i].as_py()), pa.int32())
                own = pa.ListArray.from_arrays(pa.array(np.r_[ids.first, len(ids.flat)], pa.int32()), pa.array(ids.flat))
                many = [list(v) if n > k + 1 else None for v, n in zip(vectors, ids.sizes)]
                columns = [cls, pa.array(ids.flat[ids.first]), own, pa.array(many, pa.list_(pa.float64())), *lists.columns()]
                yield pa.RecordBatch.from_arrays(columns, ["cls", "vid", "ids", "vec", "dists", "nids"])

    return run


def pack(points: DataFrame, k: int) -> str:
    """The folder of the points' blocks, in files of few."""
    folder = new_folder(points.sparkSession, "blocks")
    blocks = points.select("cls", "ids", "vec").mapInArrow(_pack(k), BLOCK)
    blocks.write.option("maxRecordsPerFile", FILE_BLOCKS).parquet(folder)
    return folder


def all_pairs(spark: SparkSession, folder: str, k: int) -> tuple[DataFrame, str]:
    """The lists of all points of these blocks, by comparing each with all of its class, and the folder they are read from.

    For data that cells cannot part. Every block meets all others, a run of files at a time, as they are read: nothing is shuffled. The lists
    travel with their block, so a round writes as much as the one before it, which is then removed.
    """
    # Comparing takes long for the bytes it reads, so files are not merged by bytes as Spark would.
    own = spark.newSession()
    own.conf.set("spark.sql.files.maxPartitionBytes", "1m")
    own.conf.set("spark.sql.files.openCostInBytes", "1m")
    read = lambda *files: own.read.schema(BLOCK).parquet(*files)
    sizes = read(folder).groupBy(F.col("_metadata.file_path").alias("file")).agg(F.sum(F.length("block")).alias("bytes")).collect()
    runs: list[list[str]] = []
    room = 0
    for r in sorted(sizes):
        if not runs or room < r["bytes"]:
            runs.append([])
            room = RUN_BYTES
        runs[-1].append(r["file"])
        room -= r["bytes"]
    none = own.range(1, numPartitions=1).select(F.lit(None).cast("int").alias("_cls"), F.lit(None).cast("binary").alias("other"))
    done, before = folder, None
    for files in runs:
        # A block that meets none of its class in this run is kept by the empty row.
        others = read(*files).select(F.col("cls").alias("_cls"), F.col("block").alias("other")).unionByName(none).coalesce(1)
        # Not an equality, for which Spark would shuffle both sides.
        alike = F.col("_cls").isNull() | ((F.col("cls") <= F.col("_cls")) & (F.col("cls") >= F.col("_cls")))
        pairs = read(done).join(others.hint("shuffle_replicate_nl"), alike).select("cls", "at", "block", "other")
        before, done = done, new_folder(spark, "compared")
        pairs.mapInArrow(_compare, BLOCK).write.option("maxRecordsPerFile", FILE_BLOCKS).parquet(done)
        if before != folder:
            remove_folder(spark, before)
    if done != folder:
        remove_folder(spark, folder)
    return spark.read.schema(BLOCK).parquet(done).mapInArrow(_lists_of(k), LISTS), done


def knn(
    df: DataFrame, row_id: str, cls: str, features: list[str] | str, k: int = 5, chunk: int = CHUNK
) -> DataFrame:
    """The ``k`` nearest other rows of the same class, ties by smaller id.

    ``features`` names numeric columns or one array column. Returns
    ``row_id, cls, rank, nn_id, distance``; rows of small classes get fewer
    than ``k`` neighbours. The class must be a whole number; rows where it is
    NULL belong to no class and have no neighbours. Copies of a vector are compared once and at most
    ``k + 2`` of their ids travel with it: all that a result can hold, and one more to tell that there are others.
    """
    spark = df.sparkSession
    vec = F.col(features).cast("array<double>") if isinstance(features, str) else F.array(
        *[F.col(c).cast("double") for c in features]
    )
    whole = F.col(cls).cast("double") == F.col(cls).cast("int")
    known = F.when(whole, F.col(cls).cast("int")).otherwise(F.raise_error(F.lit(f"{cls} must hold whole numbers")))
    rows = df.filter(F.col(cls).isNotNull()).select(F.col(row_id).cast("long").alias("id"), known.cast("int").alias("cls"), vec.alias("vec"))
    copies = Window.partitionBy("cls", "vec").orderBy("id")
    folders = {name: new_folder(spark, name) for name in ("points", "placed", "inside", "asked")}
    points = cut_to(
        rows.withColumn("r", F.row_number().over(copies))
        .filter(F.col("r") <= k + 2)
        .groupBy("cls", "vec")
        .agg(F.sort_array(F.collect_list("id")).alias("ids"))
        .withColumn("vid", F.col("ids")[0]),
        folders["points"],
    ).select("cls", "vid", "ids", "vec")
    pivots, total = _pivots(points, chunk)
    # Comparing takes long for the bytes it reads, so tasks are not merged by bytes as Spark would.
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(total / TASK_POINTS))
    kinds = "cls int, vid bigint, ids array<bigint>, vec array<double>"
    placed = cut_to(points.mapInPandas(_assign(pivots), f"{kinds}, cell int, dist double"), folders["placed"])
    remove_folder(spark, folders["points"])

    by_cell = Window.partitionBy("cls", "cell")
    closest = by_cell.orderBy("dist", "vid")
    width = max((p.shape[1] for p in pivots.values()), default=1)
    most = max(k + 2, min(chunk, CHUNK_NUMBERS // max(1, width)))
    radii = cut(
        placed.groupBy("cls", "cell").agg(F.max("dist").alias("radius"), F.ceil(F.count("*") / most).cast("int").alias("parts")), "cells"
    ).hint("broadcast")  # classes * MAX_PIVOTS rows at most
    stats = (
        placed.withColumn("r", F.row_number().over(closest))
        .filter(F.col("r") <= k + 1)
        .select("cls", "cell", "dist", "r")
        .join(radii, ["cls", "cell"])
        .collect()
    )
    reach = _reach(pivots, stats, k)
    key = ["cls", "cell", "part"]
    parted = placed.join(radii.drop("radius"), ["cls", "cell"]).withColumn("part", F.pmod(F.xxhash64("vid"), "parts").cast("int"))
    grouped = lambda some: parted.filter(some).repartition(tasks, *key).groupBy(*key).applyInArrow(_inside(pivots, reach, k), INSIDE)
    # How the points of a few cells of each class fare tells which way to go; both give the same result.
    probed = [f"(cls = {c} AND cell IN ({', '.join(map(str, _some(np.flatnonzero(np.isfinite(r[0])))))}))" for c, r in reach.items()]
    asks = grouped(F.expr(" OR ".join(probed) or "false")).groupBy("cls").agg(F.avg("asks").alias("asks")).collect()
    far = [r["cls"] for r in asks if r["asks"] > max(ASKS, FAR_SHARE * len(pivots[r["cls"]]))]
    in_cells = ~F.col("cls").isin(far)
    inside = cut_to(grouped(in_cells), folders["inside"])
    blocks = pack(placed.filter(~in_cells), k) if far else None
    remove_folder(spark, folders["placed"])
    own_vec = F.when(F.size("ids") > k + 1, F.col("vec")).alias("vec")
    lists = inside.filter("asks = 0").select("cls", "vid", "ids", own_vec, "dists", "nids")
    if len(far) < len(asks):
        lists = lists.unionByName(_asking(inside, pivots, reach, radii, k, tasks, folders["asked"], own_vec))
    if far:
        compared, folders["compared"] = all_pairs(spark, blocks, k)
        lists = lists.unionByName(compared)

    lists = lists.withColumn("near", F.arrays_zip("dists", "nids")).drop("dists", "nids")
    few = lists.filter(F.size("ids") <= k + 1).select(F.explode("ids").alias("id"), "cls", "near")
    # A vector with more copies than that has its rows looked up.
    many = lists.filter(F.size("ids") > k + 1).select("cls", "vec", "near")
    near = few.unionByName(skew_join(rows, cut(many, "many"), ["cls", "vec"], "id").select("id", "cls", "near"))
    own = F.filter("near", lambda n: n["nids"] != F.col("id"))
    found = near.select("id", "cls", F.posexplode(F.slice(own, 1, k)).alias("at", "n")).select(
        F.col("id").alias("row_id"),
        "cls",
        (F.col("at") + 1).alias("rank"),
        F.col("n.nids").alias("nn_id"),
        F.col("n.dists").alias("distance"),
    )
    found = cut(found, "nearest")
    for name in folders.keys() - {"points", "placed"}:
        remove_folder(spark, folders[name])
    return found


def _some(cells: np.ndarray) -> list[int]:
    return cells[np.linspace(0, len(cells) - 1, min(len(cells), PROBED)).astype(int)].tolist()


def _asking(
    inside: DataFrame, pivots: dict, reach: dict, cells: DataFrame, k: int, tasks: int, folder: str, own_vec: Column
) -> DataFrame:
    """The lists of the points that have to ask other cells, from what is known inside their own and what these answer."""
    key = ["cls", "cell", "part"]
    asking = inside.filter("asks > 0")
    points = asking.select("cls", "vid", F.array().cast("array<bigint>").alias("ids"), "vec", "cell", "within", F.col("cell").alias("own"), "part")
    kinds = "cls int, vid bigint, ids array<bigint>, vec array<double>, within double, own int, part int, cell int"
    sent = points.mapInPandas(_send(pivots, reach), kinds).join(cells.drop("radius"), ["cls", "cell"])
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other")
    spread = sent.select("cls", "vid", "vec", "within", "own", "part", "cell", other).filter("cell != own OR other != part")
    asked = cut_to(spread.select("cls", "vid", "vec", "within", "cell", F.col("other").alias("part")), folder)
    turns = cut(asked.groupBy(*key).agg(F.ceil(F.count("*") / ASKED_AT_ONCE).cast("int").alias("turns")), "turns").hint("broadcast")
    queries = asked.join(turns, key).withColumn("turn", F.pmod(F.xxhash64("vid"), "turns").cast("int"))
    others = inside.select(*key, "ids", "vec").join(turns, key).withColumn("turn", F.explode(F.sequence(F.lit(0), F.col("turns") - 1)))
    key = [*key, "turn"]
    found = (
        queries.select(*key, "vid", "vec", "within").repartition(tasks, *key)
        .groupBy(*key)
        .cogroup(others.select(*key, "ids", "vec").repartition(tasks, *key).groupBy(*key))
        .applyInArrow(_nearest(k), "cls int, vid bigint, dists array<double>, nids array<bigint>")
    )
    known = asking.select("cls", "vid", "ids", own_vec, F.arrays_zip("dists", "nids").alias("near"))
    answers = found.select("cls", "vid", F.lit(None).cast("array<bigint>").alias("ids"), F.lit(None).cast("array<double>").alias("vec"), F.arrays_zip("dists", "nids").alias("near"))
    merged = known.unionByName(answers).groupBy("cls", "vid").agg(
        F.first("ids", ignorenulls=True).alias("ids"), F.first("vec", ignorenulls=True).alias("vec"),
        F.slice(F.sort_array(F.flatten(F.collect_list("near"))), 1, k + 1).alias("near"),
    )
    return merged.select("cls", "vid", "ids", "vec", F.col("near.dists").alias("dists"), F.col("near.nids").alias("nids"))
