"""Quality rules with thresholds taken from the data, by DataFrame functions alone.

Each document gets a few counts. Documents that pass the fixed base rules are summed up, for each language and source, in quantile sketches: counts of
documents by value of a measure, values of up to ten bits on their own, larger ones by their ten leading bits. Such a sketch is exact to a part in 512,
has some hundred rows at most for each doubling of values, and merging two is adding their counts, so map-side merging handles any size of group, and small sources are merged to
their whole language. Fences then take the place of fixed cutoffs: the value that all but a tail share of the documents reach at most, and as many times its distance
from the median beyond. No constant stands in for a spread, so where nine in ten documents have none of something, having it for sure is beyond the fence.

Shares are lower confidence limits (a count less two standard deviations of such a count), so a single repeated line in a short text proves nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from copse.session import cut, skew_join

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MIN_GROUP = 200
"""Sources with fewer documents than this in a language share the language's thresholds."""

TAIL_TENTHS = 1
"""Tenths of a group's documents that may lie beyond the quantile from which a fence is reckoned."""

REACH = 6
"""A fence lies so many distances between median and that quantile beyond the quantile, and one unit, to which values are rounded."""

SKETCH_BITS = 10
"""Leading bits by which a sketch tells values apart."""

_BLANK = r"[\x20\x09-\x0D]+"


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once; an expression inside a lambda would be computed for each element."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _repeated_words(words: Column) -> Column:
    """Number of words inside three-word windows that occur twice or more.

    Windows are hashed (64 bits), sorted together with their places, and compared with their neighbours, so the work is that of a sort.
    """
    places = F.when(F.size(words) >= 3, F.sequence(F.lit(0), F.size(words) - 3)).otherwise(F.array().cast("array<int>"))

    def count_places(at: Column) -> Column:
        start = F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last"))
        step = lambda acc, x: F.struct((acc["n"] + F.least(F.lit(3), x - acc["last"])).alias("n"), x.alias("last"))
        return F.aggregate(at, start, step, lambda acc: acc["n"].cast("long"))

    def of_windows(h: Column) -> Column:
        def of_sorted(s: Column) -> Column:
            same = lambda v, other: F.coalesce(v["h"] == other["h"], F.lit(False))
            twice = F.filter(s, lambda v, j: same(v, F.get(s, j - 1)) | same(v, F.get(s, j + 1)))
            return count_places(F.sort_array(F.transform(twice, lambda v: v["i"])))

        placed = F.transform(h, lambda v, i: F.struct(v.alias("h"), i.alias("i")))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).otherwise(_let(F.sort_array(placed), of_sorted))

    def of_hashes(w: Column) -> Column:
        window = lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))
        return _let(F.transform(places, window), of_windows)

    return _let(F.transform(words, lambda x: F.xxhash64(x)), of_hashes)


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")


def counts(text: Column) -> Column:
    """A struct of the counts of a whole text; a NULL text has none of anything.

    n_words; word_chars, code points in words; n_symbols, characters of ``[#*$%&|<>]``; n_dup_lines, lines with a word that equal an earlier line;
    n_repeat_words, words in three-word windows found twice or more; n_lines, lines with a word.
    """

    def of_words(words: Column) -> Column:
        def of_lines(lines: Column) -> Column:
            values = {
                "n_words": F.size(words),
                "word_chars": F.char_length(F.concat_ws("", words)),
                "n_symbols": F.char_length(whole) - F.char_length(F.regexp_replace(whole, r"[#*$%&|<>]", "")),
                "n_dup_lines": F.size(lines) - F.size(F.array_distinct(lines)),
                "n_repeat_words": _repeated_words(words),
                "n_lines": F.size(lines),
            }
            return F.struct(*(values[c].cast("long").alias(c) for c in COUNTS))

        return _let(F.filter(F.split(whole, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")), of_lines)

    whole = F.coalesce(text, F.lit(""))
    return _let(F.array_remove(F.split(whole, _BLANK), ""), of_words)


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def _measures() -> dict[str, Column]:
    """Whole numbers; 0 for a document without words.

    Symbols for each thousand characters, repeated lines for each thousand lines and repeated words for each thousand words, each as a lower limit,
    and the mean length of words in tenths of a character.
    """

    def share(count: str, of: str) -> Column:
        sure = F.greatest(F.col(count) - 2 * F.sqrt(F.col(count).cast("double")), F.lit(0.0))
        return F.coalesce(F.floor(F.try_divide(1000 * sure, F.col(of).cast("double"))), F.lit(0).cast("long"))

    length = F.coalesce(F.expr("try_divide(10 * word_chars - (10 * word_chars) % n_words, n_words)").cast("long"), F.lit(0).cast("long"))
    return {
        "symbols": share("n_symbols", "word_chars"), "dup_lines": share("n_dup_lines", "n_lines"), "repeats": share("n_repeat_words", "n_words"),
        "word_length": length,
    }


BOUNDS = ("high_symbols", "high_dup_lines", "high_repeats", "low_word_length", "high_word_length")
"""The fences of a group."""


def _bucket(value: Column) -> Column:
    """The least value with the same leading bits."""
    rest = F.greatest(F.length(F.bin(value)) - SKETCH_BITS, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", value, rest), rest)


def _key(c: str) -> Column:
    return F.coalesce(F.concat(F.lit("="), F.col(f"`{c}`").cast("string")), F.lit("-"))


def measured(docs: DataFrame, text: str, lang: str, source: str, keep: list[Column]) -> DataFrame:
    """``keep``, the group keys ``_lang`` and ``_source``, and all counts and measures."""
    found = docs.select(*keep, _key(lang).alias("_lang"), _key(source).alias("_source"), counts(F.col(f"`{text}`")).alias("_counts"))
    names = [c for c in found.columns if c != "_counts"]
    found = found.select(*(F.col(f"`{c}`") for c in names), *(F.col(f"_counts.{c}").alias(f"_{c}") for c in COUNTS))
    return found


def _sketches(rows: DataFrame) -> DataFrame:
    """_lang, _source, measure, value, n of documents that pass the base rules, merged map-side."""
    pairs = F.explode(F.array(*(F.struct(F.lit(m).alias("measure"), _bucket(c).alias("value")) for m, c in _measures().items())))
    return rows.filter(~base_failed()).select("_lang", "_source", pairs.alias("_pair")).groupBy("_lang", "_source", "_pair.measure", "_pair.value").agg(F.count("*").alias("n"))


def _fences(sketches: DataFrame, keys: list[str]) -> DataFrame:
    """A row for each group: _n documents, and its fences."""
    merged = sketches.groupBy(*keys, "measure", "value").agg(F.sum("n").alias("n"))
    w = Window.partitionBy(*keys, "measure")
    run = merged.withColumn("_below", F.sum("n").over(w.orderBy("value"))).withColumn("_all", F.sum("n").over(w))
    reached = lambda tenths: F.min(F.when(10 * F.col("_below") >= tenths * F.col("_all"), F.col("value")))
    found = run.groupBy(*keys, "measure").agg(
        F.max("_all").alias("_n"), reached(TAIL_TENTHS).alias("_low"), reached(5).alias("_mid"), reached(10 - TAIL_TENTHS).alias("_high")
    )
    low = F.col("_low") - REACH * (F.col("_mid") - F.col("_low")) - 1
    high = F.col("_high") + REACH * (F.col("_high") - F.col("_mid")) + 1
    ends = [F.max(F.when(F.col("measure") == b.split("_", 1)[1], low if b.startswith("low") else high)).alias(b) for b in BOUNDS]
    return found.groupBy(*keys).agg(F.max("_n").alias("_n"), *ends)


def thresholds(rows: DataFrame) -> DataFrame:
    """The fences of each (_lang, _source): its own, or its language's where it has fewer than ``MIN_GROUP`` documents (written)."""
    sketches = cut(_sketches(rows), "quality-sketches")
    own, whole = _fences(sketches, ["_lang", "_source"]), _fences(sketches, ["_lang"])
    both = own.alias("o").join(whole.alias("w"), "_lang")
    chosen = [F.when(F.col("o._n") >= MIN_GROUP, F.col(f"o.{c}")).otherwise(F.col(f"w.{c}")).alias(c) for c in BOUNDS]
    return cut(both.select("_lang", "_source", *chosen), "quality-thresholds")


def within() -> Column:
    """Whether all measures lie between their fences. Groups without a document that passes the base rules have none, and nothing to keep."""
    measures, out = _measures(), F.lit(True)
    for b in BOUNDS:
        end, name = b.split("_", 1)
        value = measures[name]
        out = out & (F.col(b).isNull() | (value >= F.col(b) if end == "low" else value <= F.col(b)))
    return out


def judge(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, n_lines and the fences (``BOUNDS``) for each row.

    ``base_failed``: fewer than 50 words, or more than half of the words in repeated windows. ``kept``: not failed, and within the thresholds of
    its language and source. A NULL text has no words and fails; NULL languages and sources are groups of their own. Repeated rows count as
    often as they occur and are judged alike; further columns are not read; an empty table gives an empty result. Nothing depends on the partitioning.
    """
    rows = measured(docs, text, lang, source, [F.col(f"`{doc_id}`").cast("long").alias("doc_id")])
    rows = cut(rows.select("doc_id", "_lang", "_source", *(F.col(f"_{c}").alias(c) for c in COUNTS)), "quality-counts")
    joined = skew_join(rows, thresholds(rows), ["_lang", "_source"], "doc_id", how="left")
    failed = base_failed()
    return joined.select("doc_id", *COUNTS[:5], failed.alias("base_failed"), (~failed & within()).alias("kept"), "n_lines", *BOUNDS)


def filter_documents(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` (with text, lang and source) that ``judge`` keeps, all columns as they were."""
    names = docs.columns
    whole = F.struct(*(F.col(f"`{c}`") for c in names)).alias("_row")
    # Texts are counted twice, once for the sketches and once beside their rows, which is cheaper than writing them all with their counts.
    few = measured(docs, "text", "lang", "source", [])
    few = few.select("_lang", "_source", *(F.col(f"_{c}").alias(c) for c in COUNTS))
    limits = thresholds(few)
    rows = measured(docs, "text", "lang", "source", [whole])
    rows = rows.select("_row", "_lang", "_source", *(F.col(f"_{c}").alias(c) for c in COUNTS)).filter(~base_failed())
    joined = skew_join(rows, limits, ["_lang", "_source"], "_row", counted=few, how="left")
    return joined.filter(within()).select(*(F.col("_row").getField(c).alias(c) for c in names))
