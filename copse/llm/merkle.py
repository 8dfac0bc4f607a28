"""A dataset manifest: a Merkle tree over the rows of each group, one over the groups, and a proof for every row.

Digests are lower-case hexadecimal SHA-256, and a node is the digest of its children's hexadecimal text; children come in pairs, a last
one without partner alone. Leaves are sorted by range, so a partition holds runs of neighbouring leaves. Each partition hashes what it can
on its own and hands on only the topmost nodes it completes, a few dozen; those above are made from them in blocks of growing size.
Proofs are taken as an octopus multiproof: a partition lists the nodes that the proofs of all its leaves together still miss, fetches these
once, derives the interiors its leaves share, and expands the proof of each leaf from them.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from copse.session import BROADCAST_ROWS, cut, skew_join

MOST_LEAVES = 1 << 17
"""Leaves of a partition, at most (about: ranges come from a sample)."""
FEWEST_LEAVES = 1 << 12
"""Partitions are not made smaller than this for the sake of parallel work."""
PARTS_PER_BLOCK = 7
"""Nodes above the partitions are made in blocks of 2 to this power of partitions, then of as many blocks."""
_ROW_BITS = 33
"""``monotonically_increasing_id`` counts the rows of a partition in so many bits."""

LEAF_COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def leaf_digest(values: Sequence[Column]) -> Column:
    """Digest of a row: each value as ``-`` if NULL, else as its UTF-8 byte count, a colon and its text."""

    def told(value: Column) -> Column:
        text = value.cast("string")
        return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))

    return F.sha2(F.concat(*map(told, values)), 256)


def digest(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def parents(known: dict[int, str], n: int) -> dict[int, str]:
    """The nodes of the next level whose children are all known; ``n`` nodes are in this level."""
    up = {}
    for at, left in known.items():
        if at & 1:
            continue
        right = known.get(at + 1)
        if right is not None:
            up[at >> 1] = digest(left + right)
        elif at + 1 >= n:
            up[at >> 1] = digest(left)
    return up


def missing(at: np.ndarray, n: int) -> Iterator[tuple[int, int]]:
    """Level and place of each node that the proofs of the leaves ``at`` need together and that these leaves do not yield."""
    level = 0
    while n > 1:
        beside = at ^ 1
        for place in np.setdiff1d(beside[beside < n], at).tolist():
            yield level, place
        at, n, level = np.unique(at >> 1), (n + 1) // 2, level + 1


def topmost(known: dict[int, str], n: int) -> Iterator[tuple[int, int, str]]:
    """Level, place and digest of the nodes made from these leaves whose parent needs others too; a whole tree's root is one."""
    level = 0
    while known:
        up = parents(known, n) if n > 1 else {}
        for place, value in known.items():
            if place >> 1 not in up:
                yield level, place, value
        known, n, level = up, (n + 1) // 2, level + 1


def levels_of(leaves: dict[int, str], n: int, fetched: dict[tuple[int, int], str]) -> list[dict[int, str]]:
    """All nodes on the way from these leaves to the root and those beside them, by level; ``fetched`` holds what is missing."""
    by_level: dict[int, dict[int, str]] = {}
    for (level, place), value in fetched.items():
        by_level.setdefault(level, {})[place] = value
    found, known = [], leaves
    while n > 1:
        known = known | by_level.get(len(found), {})
        found.append(known)
        known, n = parents(known, n), (n + 1) // 2
    return [*found, known]


def proof(at: int, n: int, levels: Sequence[dict[int, str]]) -> list[str]:
    """The node beside each one on the way up, the empty text where there is none."""
    beside = []
    for level in levels[:-1]:
        beside.append(level[at ^ 1] if at ^ 1 < n else "")
        at, n = at >> 1, (n + 1) // 2
    return beside


def _runs(table: pa.Table) -> Iterator[tuple[str, int, dict[int, str]]]:
    """Tree, its number of leaves, and the leaves of the partition by place."""
    trees: dict[str, tuple[int, dict[int, str]]] = {}
    for tree, n, at, leaf in zip(*(table.column(c).to_pylist() for c in ("tree", "n", "at", "leaf")), strict=True):
        trees.setdefault(tree, (n, {}))[1][at] = leaf
    for tree, (n, leaves) in trees.items():
        yield tree, n, leaves


_NODE = "part long, tree string, n long, level int, at long, digest string"
_NODE_ARROW = pa.schema([("part", pa.int64()), ("tree", pa.string()), ("n", pa.int64()), ("level", pa.int32()), ("at", pa.int64()), ("digest", pa.string())])


def _nodes(rows: list[tuple]) -> pa.Table:
    return pa.Table.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*rows) if rows else [[]] * 6, _NODE_ARROW)], schema=_NODE_ARROW)


def _outline(table: pa.Table) -> pa.Table:
    """What a partition can give (nodes with a digest) and what its proofs miss (nodes without)."""
    part, rows = table.column("part")[0].as_py(), []
    for tree, n, leaves in _runs(table):
        rows += [(part, tree, n, *node) for node in topmost(leaves, n)]
        rows += [(part, tree, n, level, at, None) for level, at in missing(np.array(sorted(leaves)), n)]
    return _nodes(rows)


def _block(top: int):
    """Make the nodes of one block of a tree, up to level ``top`` or its root, from those given in it."""

    def make(table: pa.Table) -> pa.Table:
        tree, n, by_level, rows = table.column("tree")[0].as_py(), table.column("n")[0].as_py(), {}, []
        for level, at, value in zip(*(table.column(c).to_pylist() for c in ("level", "at", "digest")), strict=True):
            by_level.setdefault(level, {})[at] = value
        known: dict[int, str] = {}
        for level in range(min(by_level), top):
            known = known | by_level.get(level, {})
            here = (n + (1 << level) - 1) >> level
            if here == 1:
                break
            known = parents(known, here)
            rows += [(None, tree, n, level + 1, at, value) for at, value in known.items()]
        return _nodes(rows)

    return make


def _placed(leaves: DataFrame, order: Sequence[str], most: int) -> DataFrame:
    """Add ``part``, the place ``at`` of a leaf in its tree, and the tree's number of leaves ``n``; hand in a written table."""
    spark, total = leaves.sparkSession, leaves.count()
    parts = max(1, -(-total // most), min(2 * spark.sparkContext.defaultParallelism, -(-total // FEWEST_LEAVES)))
    in_range = leaves.repartitionByRange(parts, "tree", *order).sortWithinPartitions("tree", *order)
    placed = in_range.withColumn("_at", F.monotonically_increasing_id())
    placed = placed.withColumns({"part": F.shiftright("_at", _ROW_BITS), "_at": F.col("_at").bitwiseAND((1 << _ROW_BITS) - 1)})
    placed = cut(placed, "leaves-in-order")
    # One row for each partition and tree, so a window holds at most one row for each partition.
    runs = placed.groupBy("part", "tree").agg(F.min("_at").alias("_first"), F.count("*").alias("_size"))
    before = Window.partitionBy("tree").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumns({"_before": F.coalesce(F.sum("_size").over(before), F.lit(0)), "n": F.sum("_size").over(Window.partitionBy("tree"))})
    return placed.join(runs, ["part", "tree"]).withColumn("at", F.col("_at") - F.col("_first") + F.col("_before")).drop("_at", "_first", "_size", "_before")


def forest(leaves: DataFrame, order: Sequence[str], most: int = MOST_LEAVES) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Build a tree over the leaves of each ``tree`` (a string, not NULL) in the given order.

    ``leaves`` has columns ``tree, leaf``, those of ``order`` and any others; equal orders may stand in any order among themselves. Returns the
    leaves with ``part, at, n``; the nodes ``part, tree, level, at, digest`` that the proofs of each partition miss; and ``tree, root``.
    """
    rows = cut(_placed(leaves, order, most), "leaves")
    outline = cut(rows.select("part", "tree", "n", "at", "leaf").groupBy("part").applyInArrow(_outline, _NODE), "outline")
    given = outline.filter("digest IS NOT NULL").drop("part")
    sizes = rows.agg(F.max("n").alias("n"), F.count_distinct("part").alias("parts"), F.count("*").alias("rows")).first()
    height = max(0, (sizes["n"] or 1) - 1).bit_length()
    top = max(0, -(-sizes["rows"] // max(1, sizes["parts"])) - 1).bit_length() + PARTS_PER_BLOCK
    store, open_ = given, given
    while True:
        block = F.expr(f"shiftright(at, {top} - level)")
        made = open_.filter(F.col("level") < top).groupBy("tree", block.alias("block")).applyInArrow(_block(top), _NODE)
        made = cut(made.drop("part"), "nodes")
        store = store.unionByName(made)
        if top >= height:
            break
        open_ = open_.filter(F.col("level") >= top).unionByName(made.filter(F.col("level") == top))
        top += PARTS_PER_BLOCK
    last = F.expr("n <= shiftleft(1L, level) AND (level = 0 OR n > shiftleft(1L, level - 1))")
    wanted = outline.filter("digest IS NULL").drop("digest", "n")
    fetched = wanted.join(store.drop("n"), ["tree", "level", "at"]).select("part", "tree", "level", "at", "digest")
    return rows, fetched, store.filter(last).select("tree", F.col("digest").alias("root"))


def _expand(leaves: pa.Table, fetched: pa.Table) -> pa.Table:
    nodes: dict[str, dict[tuple[int, int], str]] = {}
    for tree, level, at, value in zip(*(fetched.column(c).to_pylist() for c in ("tree", "level", "at", "digest")), strict=True):
        nodes.setdefault(tree, {})[level, at] = value
    trees = {tree: (n, levels_of(found, n, nodes.get(tree, {}))) for tree, n, found in _runs(leaves)}
    beside = [proof(at, *trees[tree]) for tree, at in zip(leaves.column("tree").to_pylist(), leaves.column("at").to_pylist(), strict=True)]
    return leaves.append_column("beside", pa.array(beside, type=pa.list_(pa.string()))).drop_columns(["part", "n"])


def proofs(rows: DataFrame, fetched: DataFrame) -> DataFrame:
    """The leaves with ``beside``, an array of the node beside each one on the way to the root (empty where there is none).

    Bit ``k`` of ``at`` tells the side of the leaf's own node in level ``k``.
    """
    kinds = [f"`{c}` {t}" for c, t in rows.dtypes if c not in ("part", "n")]
    return rows.groupBy("part").cogroup(fetched.groupBy("part")).applyInArrow(_expand, ", ".join([*kinds, "beside array<string>"]))


def folded(leaf: Column, beside: Column, at: Column) -> Column:
    """The root that a leaf's digest and its proof lead to."""
    start = F.struct(leaf.alias("digest"), at.cast("long").alias("at"))

    def up(state: Column, node: Column) -> Column:
        own = state["digest"]
        pair = F.when(state["at"].bitwiseAND(1) == 1, F.concat(node, own)).otherwise(F.concat(own, node))
        return F.struct(F.sha2(pair, 256).alias("digest"), F.shiftright(state["at"], 1).alias("at"))

    return F.aggregate(beside, start, up, lambda state: state["digest"])


def manifest(leaves: DataFrame, group: str, order: Sequence[str], most: int = MOST_LEAVES) -> DataFrame:
    """``leaves`` (a written table with a column ``leaf``) with ``at, beside, subroot, group_at, group_beside, root``.

    One tree for each value of ``group``, NULL being one, its leaves in the given order; the trees' roots, NULL first, then by the bytes of the
    value's text, are the leaves of one more tree, whose root is ``root``. Names with a leading underscore and ``tree`` are this module's own.
    """
    key = F.coalesce(F.concat(F.lit("1"), F.col(group).cast("string")), F.lit("0"))
    rows, fetched, roots = forest(leaves.withColumn("tree", key), order, most)
    below = proofs(rows, fetched)
    groups = cut(roots.select(F.lit("").alias("tree"), F.col("tree").alias("own"), F.col("root").alias("leaf")), "subroots")
    count = groups.count()
    upper, upper_fetched, top = forest(groups, ["own"], most)
    heads = proofs(upper, upper_fetched).join(top, "tree").select(
        F.col("own").alias("tree"), F.col("leaf").alias("subroot"), F.col("at").alias("group_at"), F.col("beside").alias("group_beside"), "root"
    )
    if count <= BROADCAST_ROWS // 10:
        return below.join(F.broadcast(heads), "tree").drop("tree")
    return skew_join(below, cut(heads, "heads"), ["tree"], "leaf").drop("tree")


def verify(docs: DataFrame, most: int = MOST_LEAVES) -> DataFrame:
    """A proof for each row of ``docs``, and what becomes of it where a row has been tampered with.

    Columns: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified. Leaves are made of ``LEAF_COLUMNS``, trees by lang, in the order of
    doc_id. Rows with one id, NULL ids (first) included, stand in the order of their leaves; equal rows have equal leaves, so theirs does not
    matter. Where 7 divides the CRC-32 of the id's decimal text, the row to be proved has one added to n_chars; NULL in either means no change.
    An empty table has no rows here either; a table of one row has an empty proof, and its leaf is the root. Further columns are not read.
    """
    value = {c: F.col(f"`{c}`") for c in LEAF_COLUMNS}
    more = value | {"n_chars": value["n_chars"].cast("decimal(20,0)") + 1}
    tampered = F.crc32(value["doc_id"].cast("string").cast("binary")) % 7 == 0
    leaves = docs.select(
        value["doc_id"].alias("doc_id"), value["lang"].alias("lang"), leaf_digest(list(value.values())).alias("leaf"),
        F.when(tampered & value["n_chars"].isNotNull(), leaf_digest(list(more.values()))).alias("changed"),
        F.monotonically_increasing_id().alias("row"),
    )
    # Copies of one row are told apart by their number only, so that many of them do not meet in one range.
    found = manifest(cut(leaves, "digests"), "lang", ["doc_id", "leaf", "row"], most)
    first = folded(F.coalesce("changed", "leaf"), F.col("beside"), F.col("at"))
    siblings = F.concat(F.array_join("beside", ""), F.array_join("group_beside", ""))
    checked = found.withColumn("folded_root", folded(first, F.col("group_beside"), F.col("group_at")))
    return checked.select(
        "doc_id", "leaf", "subroot", "root", F.sha2(siblings, 256).alias("proof_sha256"), "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )
