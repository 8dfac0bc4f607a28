import math
import re

import messy
from pyspark.sql import functions as F

from copse.llm import catalog, quality


def brute_counts(text):
    t = text or ""
    w = messy.words(t)
    lines = [x for x in t.split("\n") if messy.words(x)]
    seen: dict = {}
    for i in range(len(w) - 2):
        seen.setdefault(tuple(w[i : i + 3]), []).append(i)
    covered = {i + k for at in seen.values() if len(at) > 1 for i in at for k in range(3)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered), len(lines)


def brute(rows):
    """doc_id, the counts, base_failed, kept."""
    counts = [brute_counts(r.text) for r in rows]
    failed = [c[0] < 50 or 100 * c[4] > 50 * c[0] for c in counts]

    def share(k, n):
        return math.floor(1000 * max(k - 2 * math.sqrt(k), 0.0) / n) if n else 0

    def measures(c):
        return {"symbols": share(c[2], c[1]), "dup_lines": share(c[3], c[5]), "repeats": share(c[4], c[0]), "word_length": 10 * c[1] // c[0] if c[0] else 0}

    def sketched(v):
        rest = max(v.bit_length() - quality.SKETCH_BITS, 0)
        return v >> rest << rest

    def fences(values):
        values = sorted(map(sketched, values))
        low, mid, high = (next(v for i, v in enumerate(values) if 10 * (i + 1) >= p * len(values)) for p in (1, 5, 9))
        return low - 6 * (mid - low) - 1, high + 6 * (high - mid) + 1

    groups: dict = {}
    for r, c, f in zip(rows, counts, failed):
        if not f:
            for key in ((r.lang, r.source), (r.lang,)):
                groups.setdefault(key, []).append(measures(c))
    out: dict = {}
    for r, c, f in zip(rows, counts, failed):
        kept = not f
        if kept:
            own = groups[r.lang, r.source]
            own = own if len(own) >= quality.MIN_GROUP else groups[r.lang,]
            for m, v in measures(c).items():
                low, high = fences([x[m] for x in own])
                kept &= v <= high and (m != "word_length" or v >= low)
        row = (r.doc_id, *c[:5], f, kept)
        out[row] = out.get(row, 0) + 1
    return out


COLUMNS = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]


def test_messy(spark, monkeypatch):
    monkeypatch.setattr(quality, "MIN_GROUP", 3)
    df = messy.frame(spark)
    rows = df.collect()
    assert messy.counted(quality.judge(df), COLUMNS) == brute(rows)
    assert messy.counted(quality.judge(df.repartition(7)), COLUMNS) == brute(rows)
    assert quality.judge(messy.empty(spark)).count() == 0
    kept = quality.filter_documents(df)
    assert kept.columns == df.columns
    assert kept.count() == sum(n for key, n in brute(rows).items() if key[-1])


def test_query(spark, folder, monkeypatch):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for least in (quality.MIN_GROUP, 4):
        monkeypatch.setattr(quality, "MIN_GROUP", least)
        assert messy.counted(catalog.op9_quality_rules(spark, folder), COLUMNS) == brute(docs.collect())
    monkeypatch.undo()
    good = quality.judge(docs).join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").filter("quality = 1 and not base_failed")
    assert good.filter("not kept").count() <= 0.02 * good.count()
    bad = quality.judge(docs).join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").filter("quality = 0")
    assert bad.filter("kept").count() <= 0.1 * bad.count()


def test_sql(spark, folder):
    import oracle_check

    told = oracle_check.compare(spark, oracle_check.connect(folder), folder, catalog.op9_quality_rules, catalog.SQL["op9_quality_rules"])
    assert told.startswith("ok"), told


def test_fences_follow_each_source_and_decide(spark):
    """The same texts, kept in the source whose style they have and rejected in the other; nothing but the sources' documents tells them apart."""
    plain = lambda i: " ".join(f"{'abcdefgh'[(i + k) % 8]}word{i % 13}x{k}" for k in range(60 + i % 5))
    marked = lambda i: " ".join(f"|{'abcdefgh'[(i + k) % 8]}word{i % 13}x{k}#" if k % 3 else f"##{k}" for k in range(60 + i % 5))
    long = lambda i: " ".join("abcdefgh"[(i + k) % 8] * (90 + (i + k) % 90) + str(k) for k in range(55))
    rows = [(kind, t(i)) for kind, t in (("plain", plain), ("marked", marked), ("long", long)) for i in range(250)]
    odd = [("plain", marked(1)), ("plain", long(1)), ("long", plain(1))]
    df = spark.createDataFrame([(i, t, "en", s, None) for i, (s, t) in enumerate(rows + odd)], "doc_id long, text string, lang string, source string, n_chars long")
    out = {r.doc_id: r for r in quality.judge(df).collect()}
    assert sum(not out[i].kept for i in range(750)) <= 15 and not any(out[750 + i].kept for i in range(3))
    assert out[0].high_symbols == 1 and out[250].high_symbols > 100 and out[500].low_word_length > 300 > out[0].high_word_length
    assert messy.counted(quality.judge(df), COLUMNS) == brute(df.collect())


def test_main_path_is_native(spark, folder):
    plan = quality.judge(spark.read.parquet(f"{folder}/documents.parquet"))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_windows_that_overlap(spark):
    texts = ["a b c a b c", "a a a a", "a b c d a b c e a b", "x y", "a b c x a b c", "p q r s p q r s p q"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    got = {r.i: tuple(r.c) for r in df.select("i", quality.counts(F.col("text")).alias("c")).collect()}
    assert got == {i: brute_counts(t) for i, t in enumerate(texts)}
