"""Document fingerprints as invertible Bloom lookup sketches of paragraph digests, by DataFrame functions alone.

Lines are paragraphs; long ones, and those of texts with few, are cut further at sentence ends and words chosen by their content. Each paragraph's
digest goes to one cell in each of three parts; a cell holds the number, the XOR of the digests and the XOR of their checks. Subtracting two
versions' cells leaves the digests by which they differ, and peeling recovers those: a cell with a single digest gives it away, taking
it out of its other cells may leave further single ones, and so on. A fingerprint is a sketch of ``CELLS`` cells as text. For comparing, sketches are sized by
the number of digests, so most peel at the first attempt; the others are made again with four times the cells until they do.

Cells are rows, summed by one aggregate; a step of peeling looks at one part, where no digest has two cells, and is one more aggregate. All of them keep
the partitioning by document, so digests are shuffled once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from copse.session import broadcast_if_small, cut

CELLS = 24
"""Cells of a fingerprint's text, in three parts."""

CELLS_PER_KEY = 4
"""Cells of a sketch for each digest of both versions, before rounding up to a power of two a part; below 0.8 digests a cell, peeling ends well."""

LEAST_SHARE = 32
"""Cells of a part, at least: in smaller sketches two digests share all their cells too often. Empty cells are no rows, so they cost nothing."""

GROWTH_BITS = 2
"""Each further attempt has 2 to this power times as many cells."""

SWEEPS = 4
"""Peeling goes over the three parts so many times in one attempt."""

BUCKET_ROWS = 500
MAX_BUCKETS = 20_000
"""Runs of neighbouring documents are sorted together; the first of each, at most this many, are known to the driver."""

LONG_LINE = 400
"""A longer line is cut at sentence ends; of a line of up to this length the whole is one paragraph, unless the text is a single line."""

MAX_PART = 512
"""A longer sentence is cut after words chosen by their hash, one of eight; what is still longer, after so many characters."""

_CELL = "struct<n:int,key:bigint,check:bigint>"


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once; an expression inside a lambda would be computed for each element."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def digests(text: Column) -> Column:
    """Distinct 64-bit digests of the paragraphs, cut where the content says so: lines, sentences of long or only lines, and parts of these of bounded length."""
    long = lambda x: F.length(x) > MAX_PART
    marked = lambda x: F.array_join(F.transform(F.split(x, " "), lambda w: F.when(F.pmod(F.xxhash64(w), F.lit(8)) == 0, F.concat(w, F.lit("\n"))).otherwise(w)), " ")
    pieces = lambda x: F.when(long(x), F.regexp_extract_all(x, F.lit(f"(?s).{{1,{MAX_PART}}}"), F.lit(0))).otherwise(F.array(x))
    parts = lambda x: F.when(long(x), F.flatten(F.transform(F.split(marked(x), "\n ?"), pieces))).otherwise(F.array(x))
    sentences = lambda x: F.flatten(F.transform(F.split(x, "(?<=[.!?]) +|(?<=[。！？])"), parts))

    def cut_up(lines: Column) -> Column:
        return F.flatten(F.transform(lines, lambda x: F.when((F.length(x) > LONG_LINE) | (F.size(lines) == 1), sentences(x)).otherwise(F.array(x))))

    lines = F.filter(F.split(text, "\n"), lambda x: F.length(F.trim(x)) > 0)
    made = F.filter(_let(lines, cut_up), lambda x: F.length(F.trim(x)) > 0)
    return F.array_distinct(F.transform(made, lambda x: F.xxhash64(x)))


def _check(key: Column) -> Column:
    return F.xxhash64(key, F.lit(7))


def _place(key: Column, part: int, cells: int) -> Column:
    """The cell of a digest in a part; another mix of the digest's bits for each part."""
    share = cells // 3
    shift, times = ((23, 1), (37, 3), (11, 7))[part]
    turned = key.bitwiseXOR(F.shiftrightunsigned(key, shift) * times)
    return F.lit(part * share) + F.pmod(turned, F.lit(share)).cast("int")


def _places(key: Column, cells: int) -> Column:
    """A digest with its check and its three cells."""
    a, b, c = (_place(key, p, cells).alias(f"c{p}") for p in range(3))
    return F.struct(key.alias("key"), _check(key).alias("check"), a, b, c)


def _in_cell(placed: Column, cell: Column) -> Column:
    return (placed["c0"] == cell) | (placed["c1"] == cell) | (placed["c2"] == cell)


def _cell(n: Column, key: Column, check: Column) -> Column:
    return F.struct(n.cast("int").alias("n"), key.alias("key"), check.alias("check"))


def _zero() -> Column:
    return F.lit(0).cast("long")


def sketch(keys: Column, cells: int) -> Column:
    """The cells of a set of digests."""
    add = lambda i: lambda acc, k: F.when(_in_cell(k, i), _cell(acc["n"] + 1, acc["key"].bitwiseXOR(k["key"]), acc["check"].bitwiseXOR(k["check"]))).otherwise(acc)
    made = lambda placed: F.transform(F.sequence(F.lit(0), F.lit(cells - 1)), lambda i: F.aggregate(placed, _cell(F.lit(0), _zero(), _zero()), add(i)))
    return _let(F.transform(keys, lambda k: _places(k, cells)), made)


def as_text(cells: Column, text: Column) -> Column:
    """A fingerprint as a string: its cells in hexadecimal, and a digest of the whole text, which also tells orders of paragraphs apart."""
    parts = F.transform(cells, lambda c: F.concat_ws(".", F.hex(c["n"].cast("long")), F.lower(F.hex(c["key"])), F.lower(F.hex(c["check"]))))
    return F.concat_ws(",", parts, F.lower(F.hex(F.xxhash64(text))))


def likeness(n: Column, left: Column, right: Column) -> Column:
    """Common share of the paragraphs of both: ``n`` on one side, of which ``left`` are missing on the other, which has ``right`` more."""
    return F.when(n + right == 0, F.lit(1.0)).otherwise((n - left) / (n + right))


def _heads(docs: DataFrame) -> list[int | None]:
    """First ids of runs of about ``BUCKET_ROWS`` documents by descending id, from the ids alone. Documents without id are last."""
    buckets = min(MAX_BUCKETS, max(1, -(-docs.count() // BUCKET_ROWS)))
    runs = docs.select("doc_id").filter("doc_id is not null").repartitionByRange(buckets, F.desc("doc_id"))
    heads = runs.groupBy(F.spark_partition_id()).agg(F.max("doc_id").alias("head")).collect()
    return sorted((r["head"] for r in heads), reverse=True)


def _numbers(values: list[int]) -> Column:
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>") if values else F.array().cast("array<bigint>")


def with_next(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) with ``next``, the text of the next document by descending id; after the last comes the first.

    Equal ids are ordered by their texts. Each run of neighbours is sorted on its own, with a copy of the next run's head at its end, so texts
    are shuffled once and no task holds them all.
    """
    heads = _heads(docs)
    step = 128
    coarse = F.size(F.filter(_numbers(heads[::step]), lambda h: h >= F.col("doc_id")))
    fine = F.size(F.filter(F.slice(_numbers(heads), (F.greatest(coarse, F.lit(1)) - 1) * step + 1, F.lit(step)), lambda h: h >= F.col("doc_id")))
    last = max(len(heads), 1) - 1
    bucket = F.when(F.col("doc_id").isNull(), F.lit(last)).otherwise((F.greatest(coarse, F.lit(1)) - 1) * step + fine - 1)
    rows = docs.withColumn("_bucket", bucket.cast("int"))
    # Of the ids that begin a run, copies go to the end of the run before; of the first of all, to the end of the last run.
    is_head = F.col("doc_id").eqNullSafe(F.get(_numbers(heads), F.col("_bucket"))) | F.lit(not heads)
    to = lambda b, copy: F.struct(b.cast("int").alias("bucket"), F.lit(copy).alias("copy"))
    own = to(F.col("_bucket"), 0)
    before = F.when(F.col("_bucket") == 0, F.array(own, to(F.lit(last), 2))).otherwise(F.array(own, to(F.col("_bucket") - 1, 1)))
    rows = rows.withColumn("_to", F.explode(F.when(is_head, before).otherwise(F.array(own))))
    rows = rows.select("doc_id", "text", "_to.bucket", "_to.copy")
    order = Window.partitionBy("bucket").orderBy("copy", F.desc_nulls_last("doc_id"), "text")
    return rows.withColumn("next", F.lead("text").over(order)).filter("copy = 0").drop("copy")


def compare(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next for each row.

    The edited text has its last half (rounded down) replaced by the first as many code points of the next document by descending id. A NULL text counts as
    empty; it has no paragraphs, and two texts without any are alike (1). Repeated rows, and texts under one id, follow each other
    in the order of their texts, each counting as a document. Rows without id come last. A single row is its own next. Further columns are
    not read, and an empty table gives an empty result.
    """
    docs = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    rows = with_next(docs).select(
        "doc_id", "text", "next", n.cast("long").alias("n_chars"),
        F.concat(F.substring("text", F.lit(1), n - half), F.substring("next", F.lit(1), half)).alias("edited"),
    )
    rows = rows.select(
        "doc_id", "n_chars", F.sha2(F.encode("edited", "UTF-8"), 256).alias("edited_sha256"), "text", "edited",
        *(digests(F.col(c)).alias(s) for s, c in (("a", "text"), ("e", "edited"), ("x", "next"))),
    )

    small = F.struct(*(sketch(F.col(s), CELLS).alias(s) for s in ("a", "e")))
    texts = _let(small, lambda s: F.struct(as_text(s["a"], F.col("text")).alias("own"), as_text(s["e"], F.col("edited")).alias("edited")))
    first = rows.select(F.monotonically_increasing_id().alias("row"), "doc_id", "n_chars", "edited_sha256", "a", "e", "x", texts.alias("t"))
    first = first.select("row", "doc_id", "n_chars", "edited_sha256", F.col("t.own").alias("fingerprint"), F.col("t.edited").alias("edited_fingerprint"), "a", "e", "x")
    first = cut(first, "fingerprints")
    sizes = first.select("row", "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", F.size("a").alias("n"))
    joined = sizes.join(differences(first.select("row", "a", "e", "x")), "row", "left")

    def near(name: str) -> Column:
        side = lambda s: F.coalesce(F.col(f"{s}_{name}"), F.lit(0))  # noqa: E731  no row: no difference
        return likeness(F.col("n"), side("left"), side("right")).cast("double").alias(f"near_{name}")

    return joined.select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", near("edited"), near("next"))


TASK_DIGESTS = 120_000
"""Digests compared in one task, about; their cells then fit its memory while they are peeled."""

PAIRS = {"edited": "e", "next": "x"}
"""What the text's digests (column ``a``) are compared with: the name of a comparison and the column of the other digests."""


def _hashed(key: Column, part: int, share: Column) -> Column:
    """The cell of a digest in a part of a sketch whose parts have ``share`` cells each, a power of two."""
    return F.xxhash64(key, F.lit(part)).bitwiseAND(share - 1) + share * part


def cells_of(rows: DataFrame, attempt: int) -> DataFrame:
    """The cells, as rows, of the difference of each pair of digest sets (row, a, e, x): row, pair, share, cell, n, key, check; empty ones left out."""

    def side(name: str, sign: int, keys: str) -> Column:
        wanted = F.ceil((F.size("a") + F.size(PAIRS[name])) * (CELLS_PER_KEY / 3))
        share = F.call_function("shiftleft", F.lit(1).cast("long"), F.length(F.bin(F.greatest(wanted.cast("long"), F.lit(LEAST_SHARE)) - 1)) + attempt * GROWTH_BITS)
        return F.struct(F.lit(name).alias("pair"), F.lit(sign).cast("long").alias("n"), share.alias("share"), F.col(keys).alias("keys"))

    sides = F.explode(F.array(*(side(p, sign, c) for p, other in PAIRS.items() for sign, c in ((1, "a"), (-1, other))))).alias("s")
    keys = rows.select("row", sides).select("row", "s.pair", "s.n", "s.share", F.explode("s.keys").alias("key"))
    keys = keys.withColumn("check", _check(F.col("key")))
    cells = F.explode(F.array(*(_hashed(F.col("key"), p, F.col("share")) for p in range(3)))).alias("cell")
    return _summed(keys.select("row", "pair", "share", cells, "n", "key", "check"))


def _summed(cells: DataFrame) -> DataFrame:
    added = cells.groupBy("row", "pair", "share", "cell").agg(F.sum("n").alias("n"), F.bit_xor("key").alias("key"), F.bit_xor("check").alias("check"))
    return added.filter("n <> 0 OR key <> 0 OR check <> 0")


LEFT, RIGHT = -1, -2
"""Numbers of the cells in which the digests recovered from either side are counted."""


def peeled(cells: DataFrame, part: int) -> DataFrame:
    """The cells after all digests that stand alone in a cell of ``part`` have been taken out and counted."""
    key, check, n, share, cell = (F.col(c) for c in ("key", "check", "n", "share", "cell"))
    single = (F.abs(n) == 1) & (_check(key) == check) & (cell >= share * part) & (cell < share * (part + 1))
    record = lambda c, k, x, h: F.struct(c.cast("long").alias("cell"), k.alias("n"), x.alias("key"), h.alias("check"))
    counted = record(F.when(n > 0, LEFT).otherwise(RIGHT), F.lit(1).cast("long"), _zero(), _zero())
    out = F.array(counted, *(record(_hashed(key, p, share), -n, key, check) for p in range(3) if p != part))
    moved = F.explode(F.when(single, out).otherwise(F.array(record(cell, n, key, check)))).alias("c")
    return _summed(cells.select("row", "pair", "share", moved).select("row", "pair", "share", "c.cell", "c.n", "c.key", "c.check"))


def attempted(rows: DataFrame, attempt: int) -> DataFrame:
    """row, left and right (digests on one side only) of each comparison, and whether cells are left that do not peel; no row where nothing differs."""
    digests_ = rows.agg(F.sum(F.size("a") + F.size("e") + F.size("x"))).first()[0] or 0
    cells = cells_of(rows.repartition(max(1, -(-digests_ // TASK_DIGESTS)), "row"), attempt)
    for _ in range(SWEEPS):
        for part in range(3):
            cells = peeled(cells, part)
    told = lambda name, number: F.sum(F.when((F.col("pair") == name) & (F.col("cell") == number), F.col("n")).otherwise(0))
    counts = [told(name, number).alias(f"{side}_{name}") for name in PAIRS for side, number in (("left", LEFT), ("right", RIGHT))]
    return cells.groupBy("row").agg(*counts, F.max(F.col("cell") >= 0).alias("stuck"))


def differences(rows: DataFrame) -> DataFrame:
    """row, left_edited, right_edited, left_next, right_next for rows (row, a, e, x; written); no row where nothing differs."""
    found = cut(attempted(rows, 0), "differences")
    done, attempt = found.filter("NOT stuck"), 0
    while many := found.filter("stuck").count():
        attempt += 1
        # With every attempt a sketch's cells grow fourfold and so tell apart what shared all of them.
        stuck = broadcast_if_small(found.filter("stuck").select("row"), many)
        rows = cut(rows.join(stuck, "row", "left_semi"), "stuck")
        found = cut(attempted(rows, attempt), "differences")
        done = done.unionByName(found.filter("NOT stuck"))
    return done.drop("stuck")
