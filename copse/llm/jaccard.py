"""Exact self-join of documents by the Jaccard similarity of their word shingles, and the groups that its links form.

Equal sets are one node, so copies cost nothing further. The shingles of a set are ordered from rare to frequent; two sets that
link must share a shingle among the first quarter of each (prefix), at places that leave room for the overlap they need. Two kinds of keys
bring candidates together, divided at a set size chosen by cost:

* light sets (up to the boundary): every two-shingle subset of a prefix longer by one is a key; lists are short and selective;
* heavy sets: each prefix shingle is a key, and its inverted list is scanned; light sets that are large enough to link with a heavy one
  are in these lists too.

Lists with one set are dropped at once. Each other list first elects a hub, the set with the fewest rarer shingles, and its members
are compared with that hub only. Only members that all these links together leave unconnected are then compared with each
other. That loses no connection, and a group of near copies costs its size, not its square.
Candidates are verified on the whole texts, and groups are closed by alternating star contraction in written rounds.
"""

from __future__ import annotations

import gc
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from copse.session import cut, skew_join

WORDS = 5
SAMPLE_DOCS = 20_000
"""Frequencies are estimated on about so many documents. They order the shingles; any order gives the same links."""

MAX_FREQUENT = 200_000
"""So many shingles of the sample have their own place in the order, at most; 3 MB to broadcast."""

MAX_LIGHT = 40
"""The boundary is sought up to this size; beyond, subsets outnumber any list."""

SALT_ROWS = 200_000
"""A shingle expected in more sets than this has its list dealt out over several tasks."""

MAX_BROADCAST_IDS = 500_000
"""Tables of two ids a row are broadcast up to so many rows, 8 MB, to keep texts and lists out of the shuffle; beyond, they are joined by one."""

FRAME_ENTRIES = 200_000
"""List entries that a task makes before it hands them on."""

MAX_SEEN = 1_000_000
"""Sets that a task remembers having sent; later ones may be sent twice, which changes nothing but work."""

EARLIER = 6
"""Of the lists that a set was in before, so many are known when two sets meet again; pairs met there are not made anew."""

MAPS = tuple(f"m{i}" for i in range(8))
_STEP = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63)]
_MIX = np.uint64(0x9FB21C651E98DF25)


def shingles(text: str | None) -> np.ndarray:
    """Hashes (64 bits, sorted, distinct) of a text's runs of five words; with fewer words, of all as one; without words, none."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII blanks only
    if not words:
        return np.zeros(0, dtype=np.uint64)
    if len(words) < WORDS:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words))], dtype=np.uint64)
    h = np.fromiter(map(xxhash.xxh64_intdigest, words), dtype=np.uint64, count=len(words))
    n = len(h) - WORDS + 1
    out = np.full(n, np.uint64(WORDS))
    for i in range(WORDS):
        out ^= h[i : i + n] * _STEP[i]
        out = ((out << np.uint64(29)) | (out >> np.uint64(35))) * _MIX
    return np.unique(out ^ (out >> np.uint64(32)))


def node_of(found: np.ndarray) -> int:
    """One signed 64-bit name for a set."""
    return int(np.int64(np.uint64(xxhash.xxh3_64_intdigest(found.tobytes()))))


def links(a: np.ndarray, b: np.ndarray) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= 75 * (len(a) + len(b) - both)


def _sample_counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        parts = [shingles(t) for t in batch.text]
        if parts:
            key, n = np.unique(np.concatenate(parts), return_counts=True)
            yield pd.DataFrame({"key": key.astype(np.int64), "n": n})


Frequencies = tuple[np.ndarray, np.ndarray]
"""Sampled shingles, sorted, with their expected number of documents; all others count as rare."""


def expected_documents(found: np.ndarray, common: Frequencies) -> np.ndarray:
    keys, expected = common
    if not len(keys):
        return np.zeros(len(found))
    at = np.minimum(np.searchsorted(keys, found), len(keys) - 1)
    return np.where(keys[at] == found, expected[at], 0.0)


def frequencies(docs: DataFrame) -> Frequencies:
    total = docs.count()
    share = min(1.0, SAMPLE_DOCS / max(total, 1))
    drawn = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(share * (1 << 30))
    sample = docs if share == 1.0 else docs.filter(drawn)
    counts = sample.select("text").mapInPandas(_sample_counts, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
    top = counts.filter("n > 3").orderBy(F.desc("n"), "key").limit(MAX_FREQUENT).toPandas()
    keys, expected = top.key.to_numpy(np.int64).astype(np.uint64), top.n.to_numpy(float) / share
    order = np.argsort(keys)
    return keys[order], expected[order]


def _ordered(found: np.ndarray, common: Frequencies) -> tuple[np.ndarray, np.ndarray]:
    expected = expected_documents(found, common)
    order = np.lexsort((found, expected))
    return found[order], expected[order]


def _least(n: int) -> int:
    """The overlap that any partner needs with a set of ``n``."""
    return -(-3 * n // 4)


def parity_bits(found: np.ndarray) -> bytes:
    """A bit for each residue of the hashes, set where an odd number of them falls; two bits or more for each shingle."""
    size = max(16, 1 << int(2 * len(found) - 1).bit_length())
    odd = np.bincount((found & np.uint64(size - 1)).astype(np.int64), minlength=size) & 1
    return np.packbits(odd.astype(bool)).tobytes()


def small_maps(found: np.ndarray) -> list[int]:
    """Parity bits of 512 residues, as signed longs: coarse, but cheap to compare while lists are joined."""
    size = 64 * len(MAPS)
    odd = np.bincount((found & np.uint64(size - 1)).astype(np.int64), minlength=size) & 1
    return np.packbits(odd.astype(bool)).view(np.int64).tolist()


def least_difference(a: bytes, b: bytes) -> int:
    """A lower bound of the number of shingles on one side only: each turns one bit. The longer map is folded to the shorter."""
    x, y = sorted((np.frombuffer(a, dtype=np.uint8), np.frombuffer(b, dtype=np.uint8)), key=len)
    while len(y) > len(x):
        y = y[: len(y) // 2] ^ y[len(y) // 2 :]
    return int(np.bitwise_count(x ^ y).sum())


def _prefix(found: np.ndarray, common: Frequencies) -> tuple[np.ndarray, np.ndarray]:
    """The shingles that a partner must share some of, longer by one than for one shared shingle, and their expected documents."""
    ordered, expected = _ordered(found, common)
    size = min(len(found), len(found) - _least(len(found)) + 2)
    return ordered[:size], expected[:size]


def signature_pass(common) -> object:
    """docs (doc_id as a string, text) to doc_id, n_shingles, node, bits, and the cost of scanning its lists."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for key, text in zip(batch.doc_id, batch.text, strict=True):
                found = shingles(text)
                if not len(found):
                    rows.append((key, 0, None, None, 0.0, None, None, None, None))
                    continue
                _, expected = _prefix(found, common.value)
                rows.append((key, len(found), node_of(found), parity_bits(found), float(expected[:-1].sum() + len(expected)), *small_maps(found)))
            # As objects: beside a missing one, 64-bit numbers would become floats and lose their last digits.
            out = pd.DataFrame(rows, columns=["doc_id", "n_shingles", "node", "bits", "cost", *MAPS], dtype=object)
            yield out.astype({"n_shingles": "int64", "cost": float, **dict.fromkeys(["node", *MAPS], "Int64")})

    return run


def choose_boundary(signatures: DataFrame) -> int:
    """The size up to which sets are light: where keys made plus lists scanned are fewest."""
    size = F.least("n_shingles", F.lit(2 * MAX_LIGHT))
    found = signatures.filter("n_shingles > 2").groupBy(size.alias("size")).agg(F.count("*").alias("n"), F.sum("cost").alias("cost")).collect()
    n, cost = {r["size"]: r["n"] for r in found}, {r["size"]: r["cost"] for r in found}

    def total(boundary: int) -> float:
        subsets = sum(n.get(s, 0) * (p := s - _least(s) + 2) * (p - 1) / 2 for s in range(3, boundary + 1))
        return subsets + sum(c for s, c in cost.items() if 4 * s >= 3 * (boundary + 1))

    return min(range(2, MAX_LIGHT + 1), key=total)


def key_pass(common, boundary: int) -> object:
    """docs (text) to list entries: key, salt (0 where the list is not dealt out), node, n, pos (shingles known to be before the first shared one), kind.

    A task sends each set once, so many copies of one text make no long lists.
    """

    def frame(parts: list[tuple]) -> pd.DataFrame:
        """Of (key, pos, node, n, kind), one of each set."""
        lengths = [len(p[0]) for p in parts]
        key, pos = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
        node, n, kind = (np.repeat(np.array([p[i] for p in parts], dtype=t), lengths) for i, t in ((2, np.int64), (3, np.int32), (4, np.int8)))
        spread = np.ceil(expected_documents(key, common.value) / SALT_ROWS).astype(np.int64)
        salt = 1 + (node.astype(np.uint64) >> np.uint64(7)).astype(np.int64) % np.maximum(spread, 1)
        return pd.DataFrame({
            "key": key.astype(np.int64), "salt": np.where(spread > 1, salt, 0).astype(np.int32), "node": node, "n": n, "pos": pos.astype(np.int32), "kind": kind,
        })

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: set[int] = set()
        parts: list[tuple] = []
        held = 0
        for batch in batches:
            for text in batch.text:
                found = shingles(text)
                n = len(found)
                if n < 3 or (node := node_of(found)) in seen:  # sets of one or two link with equal ones only
                    continue
                if len(seen) < MAX_SEEN:
                    seen.add(node)
                prefix, _ = _prefix(found, common.value)
                if n <= boundary:
                    i, j = np.triu_indices(len(prefix), 1)
                    parts.append(((prefix[i] * _STEP[0]) ^ (prefix[j] * _STEP[1] + _STEP[2]), j - 1, node, n, 0))
                    held += len(i)
                if 4 * n >= 3 * (boundary + 1):
                    single = prefix[: n - _least(n) + 1]
                    parts.append((single, np.arange(len(single)), node, n, 2 if n > boundary else 1))
                    held += len(single)
                if held >= FRAME_ENTRIES:
                    yield frame(parts)
                    parts, held = [], 0
        if parts:
            yield frame(parts)

    return run


def shared_lists(docs: DataFrame, common, boundary: int) -> DataFrame:
    """The entries of all lists that hold more than one set (written): key, node, n, kind, at, reach.

    ``at`` is the share of a set that is rarer than the key; ``reach`` the largest partner that an entry's place leaves room for.
    """
    entries = docs.select("text").mapInPandas(key_pass(common, boundary), "key long, salt int, node long, n int, pos int, kind byte")
    # A list that is salted is long by expectation; the others are kept if they have two different sets.
    w = Window.partitionBy("key", "salt")
    several = (F.min("node").over(w) < F.max("node").over(w)) | (F.col("salt") > 0)
    reach = F.least(F.floor(F.col("n") * 4 / 3), F.floor((F.col("n") - F.col("pos")) * 7 / 3) - F.col("n")).cast("int")
    at = (F.col("pos") / F.col("n")).cast("float").alias("at")
    kept = entries.withColumn("_several", several).filter("_several").select("key", "node", "n", "kind", at, reach.alias("reach"))
    return cut(kept, "jaccard-lists")


def _fits(a: str, b: str) -> str:
    """Sizes and places allow a link, and not both are light sets in a list meant for heavy ones."""
    return f"{a}.node <> {b}.node and {b}.n <= {a}.reach and {a}.n <= {b}.reach and not ({a}.kind = 1 and {b}.kind = 1)"


def _pairs(joined: DataFrame, a: str, b: str) -> DataFrame:
    return joined.select(F.expr(f"least({a}.node, {b}.node)").alias("a"), F.expr(f"greatest({a}.node, {b}.node)").alias("b")).distinct()


def hub_pairs(lists: DataFrame) -> DataFrame:
    """Each list's members with its hub, where sizes and places allow a link."""
    best = F.min(F.struct("at", "node", "n", "kind", "reach")).alias("_hub")
    hubs = lists.groupBy("key").agg(best).select("key", "_hub.node", "_hub.n", "_hub.kind", "_hub.reach")
    return _pairs(lists.alias("m").join(hubs.alias("h"), F.expr(f"m.key = h.key and {_fits('m', 'h')}")), "m", "h")


def cross_pairs(lists: DataFrame, linked: DataFrame, nodes: DataFrame) -> DataFrame:
    """Members of a list that no links connect, where sizes, places and small parity maps allow a link. ``linked``: a, b (written).

    Sets that share one list often share many. Each entry knows the last lists that its set was in before, by the common order of shingles; where
    both sets know the same one, they have met there, at places that allow no less, and are not paired again.
    """
    # Members of one component are connected already, by however many links.
    label = _small_side(components(lists.sparkSession, linked).withColumnRenamed("component", "_label"))
    rows = lists.join(label, "node", "left").withColumn("label", F.coalesce("_label", "node")).drop("_label")
    w = Window.partitionBy("key")
    mixed = rows.withColumn("_mixed", F.min("label").over(w) < F.max("label").over(w)).filter("_mixed").drop("_mixed")
    before = Window.partitionBy("node", F.col("kind") == 0).orderBy("at", "key")
    mixed = mixed.withColumn("earlier", F.array_compact(F.array(*(F.lag("key", i).over(before) for i in range(1, EARLIER + 1))))).drop("at")
    mixed = cut(mixed.join(nodes.select("node", *MAPS), "node"), "jaccard-mixed")
    free_shuffles(lists.sparkSession)
    turned = " + ".join(f"bit_count(x.{m} ^ y.{m})" for m in MAPS)
    on = (
        f"7 * ({turned}) <= x.n + y.n and x.key = y.key and x.label <> y.label and (x.n < y.n or (x.n = y.n and x.node < y.node)) and {_fits('x', 'y')} "
        "and not ((x.kind = 0) = (y.kind = 0) and arrays_overlap(x.earlier, y.earlier))"
    )
    return _pairs(mixed.alias("x").join(mixed.alias("y"), F.expr(on)), "x", "y")


def free_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of what has been written since; it does so only when the driver's garbage is collected."""
    gc.collect()
    spark._jvm.System.gc()


def _small_side(written: DataFrame) -> DataFrame:
    """A written table of a few longs a row, to be broadcast if it has few enough rows, else to be joined by a shuffle."""
    return F.broadcast(written) if written.count() <= MAX_BROADCAST_IDS else written


def _may_link(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        columns = (batch.a, batch.b, batch.n_a, batch.n_b, batch.bits_a, batch.bits_b)
        found = [(a, b) for a, b, n, m, x, y in zip(*columns, strict=True) if 7 * least_difference(x, y) <= n + m]
        yield pd.DataFrame(found, columns=["a", "b"], dtype=np.int64)


def screened(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The pairs (a, b) whose parity bits leave room for a link (written); no link is lost, and most others end here."""
    side = lambda x: nodes.select(F.col("node").alias(x), F.col("n").alias(f"n_{x}"), F.col("bits").alias(f"bits_{x}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "n_a", "n_b", "bits_a", "bits_b")
    return cut(both.mapInPandas(_may_link, "a long, b long"), "jaccard-pairs")


def _of_node(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Texts that have the node's set: an id that several texts share, or a NULL one, also finds others."""
    for batch in batches:
        yield batch[[node_of(shingles(t)) == n for n, t in zip(batch.node, batch.text, strict=True)]]


def _verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    key, hub = None, np.zeros(0, dtype=np.uint64)
    for batch in batches:
        found = []
        for a, b, text_a, text_b in zip(batch.a, batch.b, batch.text_a, batch.text_b, strict=True):
            if a != key:
                key, hub = a, shingles(text_a)
            if links(hub, shingles(text_b)):
                found.append((a, b))
        yield pd.DataFrame(found, columns=["a", "b"], dtype=np.int64)


def verified(pairs: DataFrame, docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The pairs (a, b) of nodes that link by their whole texts (written). ``nodes``: node, doc_id of one document, n, bits."""
    pairs = screened(pairs, nodes)
    ends = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    wanted = cut(nodes.select("node", "doc_id").join(ends, "node", "left_semi"), "jaccard-wanted")
    found = docs.alias("d").join(_small_side(wanted).alias("w"), F.expr("d.doc_id <=> w.doc_id")).select("w.node", "d.text")
    texts = cut(found.mapInPandas(_of_node, "node long, text string").dropDuplicates(["node"]), "jaccard-texts")
    with_b = pairs.join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b")
    both = with_b.join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")
    return cut(both.select("a", "b", "text_a", "text_b").mapInPandas(_verify, "a long, b long"), "jaccard-links")


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """node, component: the smallest node reachable (written). Alternating large and small stars; the number of rounds grows with the logarithm of the length of chains.

    A star's centre is chosen by an aggregate merged map-side, and no round lists a node's neighbours in one place.
    """
    now = cut(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "jaccard-cc")
    while True:
        # Large star: each node's larger neighbours join its smallest.
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = cut(large, "jaccard-cc")
        # Small star: each node and its smaller neighbours join the smallest of these.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least, "u")
        small = joined.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v"))).distinct()
        small = cut(small, "jaccard-cc")
        # Stars: no node is both an end and a centre, and each has one centre.
        ends = small.select("u").union(small.select(F.col("v").alias("u")).distinct()).groupBy("u").count().filter("count > 1")
        if not ends.limit(1).count():
            return small.select(F.col("u").alias("node"), F.col("v").alias("component"))
        now = small


def join_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """One row for each row of ``docs`` (doc_id, n_shingles, node, component, component_id), and verified links between nodes (a, b).

    The links connect each component but are a subset of all: pairs that a common hub connects are not verified, so links cannot be counted here.

    ``component_id`` is the smallest doc_id reachable by links of similarity 0.75 or more, the document's own included. Texts
    that are NULL, empty or without words have no shingles and link with nothing, so each is its own component. Copies are one node;
    repeated rows are answered alike. A NULL doc_id takes part, but never names a component unless no other is there. Where ids are NULL or
    repeated, components may share a ``component_id``; ``component``, the smallest of a component's nodes, tells them apart. Further columns are not read.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    common = spark.sparkContext.broadcast(frequencies(docs))  # two arrays
    schema = "doc_id string, n_shingles long, node long, bits binary, cost double, " + ", ".join(f"{m} long" for m in MAPS)
    named = docs.withColumn("doc_id", F.col("doc_id").cast("string")).mapInPandas(signature_pass(common), schema)
    signatures = cut(named.withColumn("doc_id", F.col("doc_id").cast("long")), "jaccard-signatures")
    lists = shared_lists(docs, common, choose_boundary(signatures))
    free_shuffles(spark)
    of_node = (F.min("doc_id").alias("doc_id"), F.min("n_shingles").alias("n"), F.min("bits").alias("bits"), *(F.min(m).alias(m) for m in MAPS))
    nodes = cut(signatures.filter("node is not null").groupBy("node").agg(*of_node), "jaccard-nodes")
    linked = verified(hub_pairs(lists), docs, nodes)
    free_shuffles(spark)
    more = cross_pairs(lists, linked, nodes).join(linked, ["a", "b"], "left_anti")
    linked = cut(linked.union(verified(more, docs, nodes)), "jaccard-links")
    free_shuffles(spark)
    # The name of a component is its smallest doc_id.
    members = components(spark, linked).join(nodes.select("node", "doc_id"), "node", "right").withColumn("component", F.coalesce("component", "node"))
    names = members.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    named = skew_join(members.select("node", "component"), names, ["component"], "node").select("node", "component", "component_id")
    rows = skew_join(signatures.select("doc_id", "n_shingles", "node"), named, ["node"], "doc_id", how="left")
    rows = rows.withColumn("component_id", F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id")))
    return rows.select("doc_id", "n_shingles", "node", "component", "component_id"), linked


def component_table(docs: DataFrame) -> DataFrame:
    return join_groups(docs)[0].drop("node", "component")


def _nodes(texts: pd.Series) -> pd.Series:
    found = (shingles(t) for t in texts)
    return pd.Series([node_of(s) if len(s) else None for s in found], dtype="Int64")


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each component of ``docs``, all columns as they were: that with its smallest id, and of several rows with that id, one.

    Unlinked texts stay all, also those without id or under one id. Rows without words are components of their own and stay, repeated ones too.
    """
    groups = join_groups(docs, doc_id, text)[0].filter("node is not null")
    # Of a component, the smallest id and of its nodes the smallest.
    named = groups.filter(F.col("doc_id").eqNullSafe(F.col("component_id"))).groupBy("component")
    best = named.agg(F.min("component_id").alias("_id"), F.min("node").alias("_node"))
    whole = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row")
    rows = docs.select(whole, F.col(f"`{doc_id}`").cast("long").alias("_id"), F.pandas_udf(_nodes, "long")(F.col(f"`{text}`")).alias("_node"))
    rows = cut(rows, "jaccard-rows")
    chosen = rows.alias("r").join(best.alias("b"), F.expr("r._id <=> b._id and r._node = b._node"), "left_semi")
    first = chosen.withColumn("_first", F.row_number().over(Window.partitionBy("_id", "_node").orderBy(F.to_json("_row")))).filter("_first = 1")
    names = [F.col("_row").getField(c).alias(c) for c in docs.columns]
    return first.select(*names).unionByName(rows.filter("_node is null").select(*names))
