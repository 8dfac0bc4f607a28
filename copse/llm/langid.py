"""Language of a text by bit-sliced Bloom filters over character trigrams.

One filter serves all languages: each slot holds a bit for every language, and ANDing the slots of a trigram's probes
returns the set of languages that (seem to) contain it. A text's trigrams are counted for each language, the counts are corrected
for the share of false positives that the language's own fill predicts, and the largest count decides.

Learning reads all labelled rows. Counting, and choosing the ``TOP_GRAMS`` most frequent trigrams of each language, is done by
Spark; what reaches the driver is bounded by that number and the number of languages. Classifying reads every character of every text.

Whether a text is in any learnt language at all is decided by the share of its trigrams that its best language knows. What share to expect
is taken from labelled documents kept out of learning: those of the language, and those of others that come closest to it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

TOP_GRAMS = 8_000
"""Keep so many trigrams of each language at most."""

MIN_RATIO = 0.5
"""A trigram belongs to a language if it is at least this share as frequent there as where it is most frequent."""

DEVIATIONS = 3.0
"""A text's hits may stay this many standard deviations below the limit, and must be as many above chance, so short texts are judged mildly."""

SLOT_BITS = 18
PROBES = 2
MAX_LANGUAGES = 1_024
UNKNOWN = "und"

_NO_LETTERS = re.compile(r"[\W\d_]+")
_CHUNK = 1 << 20
_HELD = 1 << 21
_FRAME = 1 << 16
_MIX = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


def _grams(text: str) -> Iterator[np.ndarray]:
    """Trigrams of letters, words being set off by one blank, as packed code points; in chunks, so long texts need little memory."""
    words = _NO_LETTERS.sub(" ", text.lower()).strip()
    if words and not words.replace(" ", "").isalpha():
        # Digits of other kinds, fractions and numerals count as word characters, but are no letters.
        words = " ".join("".join(c if c.isalpha() else " " for c in words).split())
    if not words:
        return
    codes = np.frombuffer(f" {words} ".encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    for at in range(0, len(codes) - 2, _CHUNK):
        c = codes[at : at + _CHUNK + 2].astype(np.int64)
        yield (c[:-2] << 42) | (c[1:-1] << 21) | c[2:]


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct trigrams of several lists with counts, and the sums of their counts."""
    gram, at = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    n = np.zeros(len(gram), dtype=np.int64)
    np.add.at(n, at, np.concatenate([p[1] for p in parts]))
    return gram, n


def _count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Trigrams of each language with their counts, merged as far as ``_HELD`` entries go, so tasks need little memory."""
    held: dict[str, list] = {}
    size = 0
    for batch in batches:
        for lang, texts in batch.groupby("lang").text:
            for t in texts:
                for g in _grams(t):
                    found = np.unique(g, return_counts=True)
                    held.setdefault(lang, []).append(found)
                    size += len(found[0])
                    if size > _HELD:
                        held = {k: [_merged(p)] for k, p in held.items()}
                        size = sum(len(p[0][0]) for p in held.values())
                        if 2 * size > _HELD:
                            yield from _frames(held)
                            held, size = {}, 0
    yield from _frames(held)


def _frames(held: dict[str, list]) -> Iterator[pd.DataFrame]:
    for lang, parts in held.items():
        gram, n = _merged(parts)
        for at in range(0, len(gram), _FRAME):
            yield pd.DataFrame({"lang": lang, "gram": gram[at : at + _FRAME], "n": n[at : at + _FRAME]})


class LanguageFilter:
    """The bit-sliced filter: ``slices[w][slot]`` has the bits of languages 64 w and up."""

    def __init__(self, languages: list[str], slices: np.ndarray):
        self.languages, self.slices = languages, slices
        fill = [((slices[i // 64] >> np.uint64(i % 64)) & np.uint64(1)).mean() for i in range(len(languages))]
        self.false_share = np.array(fill) ** PROBES

    @classmethod
    def of(cls, languages: list[str], members: list[np.ndarray]) -> LanguageFilter:
        """A filter in which each language has its trigrams."""
        slices = np.zeros((max(1, -(-len(languages) // 64)), 1 << SLOT_BITS), dtype=np.uint64)
        for i, grams in enumerate(members):
            for slots in cls._slots(grams):
                slices[i // 64, slots] |= np.uint64(1 << (i % 64))
        return cls(languages, slices)

    @staticmethod
    def _slots(grams: np.ndarray) -> list[np.ndarray]:
        h = grams.astype(np.uint64) * np.uint64(_MIX[0])
        h ^= h >> np.uint64(29)
        h *= np.uint64(_MIX[1])
        return [(h >> np.uint64(64 - SLOT_BITS)).astype(np.int64), (h & np.uint64((1 << SLOT_BITS) - 1)).astype(np.int64)]

    def hits(self, text: str | None) -> tuple[int, np.ndarray]:
        """The number of a text's trigrams, and for each language of those it knows, corrected for false positives."""
        total, hits = 0, np.zeros(len(self.languages))
        for grams in _grams(text or ""):
            total += len(grams)
            first, second = self._slots(grams)
            for w, bits in enumerate(self.slices):
                found = bits[first] & bits[second]
                for i in range(64 * w, min(64 * w + 64, len(self.languages))):
                    hits[i] += np.count_nonzero(found & np.uint64(1 << (i % 64)))
        return total, np.clip((hits - total * self.false_share) / (1 - self.false_share), 0, None)

    def classify(self, text: str | None) -> tuple[str, float]:
        """Language and score of one text; ``und`` and 0 without any letter."""
        total, true = self.hits(text)
        if not total or not self.languages:
            return UNKNOWN, 0.0
        best = int(true.argmax())
        return self.languages[best], float(true[best] / true.sum()) if true.sum() else 0.0

    def knows(self, text: str | None, limits: np.ndarray) -> bool:
        """Whether the best language's hits are more than chance, and no less than a share ``limits`` of the trigrams would make likely."""
        total, true = self.hits(text)
        if not total or not self.languages:
            return False
        best = int(true.argmax())
        limit, false = limits[best], self.false_share[best]
        chance = DEVIATIONS * np.sqrt(total * false / (1 - false))
        least = total * limit - DEVIATIONS * np.sqrt(total * limit * (1 - limit))
        return bool(true[best] > chance and true[best] >= least)


def learn(rows: DataFrame, text: str, lang: str) -> LanguageFilter:
    """Fit the filter on labelled rows, all of them.

    Rows without text or language are left out. Rows repeated in the table count as often as they occur. No labelled rows at all give a filter
    that knows no language and answers ``und``.
    """
    rows = rows.select(F.col(f"`{lang}`").alias("lang"), F.col(f"`{text}`").alias("text"))
    rows = rows.filter("text is not null and lang is not null")
    languages = rows.select("lang").distinct().limit(MAX_LANGUAGES + 1).collect()
    if len(languages) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    if not languages:
        return LanguageFilter.of([], [])
    counts = rows.mapInPandas(_count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    top = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    counts = counts.withColumn("_rank", F.row_number().over(top)).filter(F.col("_rank") <= TOP_GRAMS).drop("_rank")
    found = counts.toPandas()
    found["p"] = found.n / found.groupby("lang").n.transform("sum")
    found = found[found.p >= MIN_RATIO * found.groupby("gram").p.transform("max")]
    languages = sorted(found.lang.unique())
    return LanguageFilter.of(languages, [found.gram[found.lang == x].to_numpy() for x in languages])


def classifier(spark, model: LanguageFilter):
    """A column function from text to ``struct<lang_pred string, score double>``; the filter (2 MB for 64 languages) is broadcast."""
    sent = spark.sparkContext.broadcast((model.languages, model.slices))

    def classify(texts: pd.Series) -> pd.DataFrame:
        model = LanguageFilter(*sent.value)
        return pd.DataFrame([model.classify(t) for t in texts], columns=["lang_pred", "score"])

    return F.pandas_udf(classify, "lang_pred string, score double")


def held_out(key: Column) -> Column:
    """Whether a document is kept out of learning: a third of all, by CRC. Never NULL; a NULL key is not held out."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def predict(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` for each row.

    Learns from the labelled rows that are not held out. A NULL text, an empty one, or one without letters is ``und`` with score 0. A text
    with letters, none of whose trigrams is known, gets the first language and score 0; if nothing was learnt, ``und``. A
    tie goes to the language that sorts first. Repeated rows are answered alike, further columns are not read, and an empty table
    gives an empty result.
    """
    key = F.col(f"`{doc_id}`")
    model = learn(docs.filter(~held_out(key)), text, lang)
    answer = classifier(docs.sparkSession, model)
    rows = docs.select(key.alias("doc_id"), held_out(key).alias("held_out"), answer(F.col(f"`{text}`")).alias("_answer"))
    return rows.select("doc_id", "held_out", "_answer.lang_pred", "_answer.score")


def known_shares(docs: DataFrame, model: LanguageFilter, doc_id: str, text: str, lang: str) -> np.ndarray:
    """For each language, the share of trigrams that a text in it must have known: midway between the median of its own documents and that
    of documents of other languages for which it comes next.

    All held-out documents with a label are measured; those that are not held out only for languages that have no others. Without other languages' documents, the lower end is 0.
    """
    key = F.col(f"`{doc_id}`")
    rows = docs.select(F.col(f"`{text}`").alias("text"), F.col(f"`{lang}`").alias("lang"), held_out(key).alias("held"))
    rows = rows.filter(F.col("text").isNotNull() & F.col("lang").isin(model.languages))
    kinds = {(r["lang"], r["held"]) for r in rows.select("lang", "held").distinct().collect()}
    if not kinds:
        return np.zeros(len(model.languages))
    asked = rows.filter(F.col("held") | ~F.col("lang").isin([k for k, held in kinds if held])).select("lang", "text")
    sent = docs.sparkSession.sparkContext.broadcast((model.languages, model.slices))

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = LanguageFilter(*sent.value)
        place = {x: i for i, x in enumerate(model.languages)}
        for batch in batches:
            found = []
            for label, t in zip(batch.lang, batch.text, strict=True):
                total, true = model.hits(t)
                if not total:
                    continue
                own, share = place[label], true / total
                found.append((label, True, share[own]))
                share[own] = -1
                if len(share) > 1:
                    found.append((model.languages[int(share.argmax())], False, share.max()))
            yield pd.DataFrame(found, columns=["lang", "own", "share"]).astype({"lang": str, "own": bool, "share": float})

    # Shares in thousandths, so a median needs no more than as many counts.
    measured = asked.mapInPandas(measure, "lang string, own boolean, share double").withColumn("share", F.round("share", 3))
    middle = {(r.lang, r.own): r.middle for r in measured.groupBy("lang", "own").agg(F.percentile("share", 0.5).alias("middle")).collect()}
    ends = [(middle.get((x, True), 0.0), middle.get((x, False), 0.0)) for x in model.languages]
    return np.array([(own + other) / 2 if own else 0.0 for own, other in ends])


def filter_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """The rows of ``docs`` whose text is in a learnt language, all columns as they were.

    Rejected are texts without letters, and those of whose trigrams too few are known to their best language (``known_shares``): noise,
    and languages that were never learnt.
    """
    key = F.col(f"`{doc_id}`")
    model = learn(docs.filter(~held_out(key)), text, lang)
    sent = docs.sparkSession.sparkContext.broadcast((model.languages, model.slices, known_shares(docs, model, doc_id, text, lang)))

    def known(texts: pd.Series) -> pd.Series:
        model, limits = LanguageFilter(*sent.value[:2]), sent.value[2]
        return pd.Series([model.knows(t, limits) for t in texts], dtype=bool)

    whole = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row")
    kept = docs.select(whole, F.pandas_udf(known, "boolean")(F.col(f"`{text}`")).alias("_known")).filter("_known")
    return kept.select(*(F.col("_row").getField(c).alias(c) for c in docs.columns))
