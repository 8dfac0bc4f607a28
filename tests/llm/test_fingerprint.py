import hashlib
import random
import re

import messy
import xxhash
from pyspark.sql import functions as F

from copse.llm import catalog, fingerprint


def parts(sentence):
    if len(sentence) <= fingerprint.MAX_PART:
        return [sentence]
    words, now, made = sentence.split(" "), [], []
    for i, w in enumerate(words):
        now.append(w)
        if chosen(w) and i + 1 < len(words):
            made.append(" ".join(now))
            now = []
    made.append(" ".join(now))
    return [p[i : i + fingerprint.MAX_PART] for p in made for i in range(0, len(p), fingerprint.MAX_PART)]


def chosen(word):
    """xxhash64 of Spark, seed 42, divisible by eight."""
    return xxhash.xxh64_intdigest(word.encode(), seed=42) % 8 == 0


def paragraphs(text):
    lines = [x for x in text.split("\n") if x.strip(" ")]
    out = set()
    for x in lines:
        if len(x) > fingerprint.LONG_LINE or len(lines) == 1:
            out |= {p for s in re.split("(?<=[.!?]) +|(?<=[。！？])", x) for p in parts(s) if p.strip(" ")}
        else:
            out.add(x)
    return out


def near(a, b):
    a, b = paragraphs(a), paragraphs(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def brute(rows):
    order = sorted(((r.doc_id, r.text or "") for r in rows), key=lambda x: (x[0] is None, -(x[0] or 0), x[1].encode()))
    out: dict = {}
    for i, (key, text) in enumerate(order):
        after = order[(i + 1) % len(order)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        row = (key, len(text), hashlib.sha256(edited.encode()).hexdigest(), round(near(text, edited), 9), round(near(text, after), 9))
        out[row] = out.get(row, 0) + 1
    return out


def found(df):
    return messy.counted(df.select("doc_id", "n_chars", "edited_sha256", F.round("near_edited", 9), F.round("near_next", 9)))


def test_query_equals_brute_force(spark, folder):
    rows = spark.read.parquet(f"{folder}/documents.parquet").collect()
    out = catalog.op10_fingerprints(spark, folder).persist()
    assert found(out) == brute(rows)
    texts = {r.doc_id: r.text for r in rows}
    prints: dict = {}
    for r in out.collect():
        prints.setdefault(r.fingerprint, set()).add(texts[r.doc_id])
    assert all(len(x) == 1 for x in prints.values()) and len(prints) == len(set(texts.values()))


def test_messy(spark, monkeypatch):
    df = messy.frame(spark)
    want = brute(df.collect())
    assert found(fingerprint.compare(df)) == want
    monkeypatch.setattr(fingerprint, "BUCKET_ROWS", 4)
    assert found(fingerprint.compare(df.repartition(9))) == want
    assert fingerprint.compare(messy.empty(spark)).count() == 0
    one = df.filter("doc_id = 13").limit(1)
    assert found(fingerprint.compare(one)) == brute(one.collect())
    nameless = df.withColumn("doc_id", F.lit(None).cast("long"))
    assert found(fingerprint.compare(nameless)) == brute(nameless.collect())


def test_many_runs(spark, monkeypatch):
    monkeypatch.setattr(fingerprint, "BUCKET_ROWS", 3)
    rng = random.Random(1)
    ids = rng.sample(range(-(10**12), 10**12), 900)
    df = spark.createDataFrame([(i, f"{i}\n{i % 7}") for i in ids], "doc_id long, text string").repartition(6)
    assert found(fingerprint.compare(df)) == brute(df.collect())


def test_long_documents_retry_larger(spark):
    lines = [f"line {i}" for i in range(3_000)]
    texts = ["\n".join(lines), "\n".join(lines[:2_000] + ["x"] + lines[2_001:]), "\n".join(lines[:100]), "\n".join(f"other {i}" for i in range(700))]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    assert found(fingerprint.compare(df)) == brute(df.collect())


def test_peeling_recovers_or_tells(spark, monkeypatch):
    rng = random.Random(2)
    rows = []
    for n in (0, 1, 5, 10, 40, 200):
        for _ in range(20):
            common = [rng.getrandbits(63) for _ in range(30)]
            left = [rng.getrandbits(63) for _ in range(n // 2)]
            right = [rng.getrandbits(63) for _ in range(n - n // 2)]
            rows.append((len(rows), n, common + left, common + right, common))
    df = spark.createDataFrame(rows, "row long, n int, a array<long>, e array<long>, x array<long>")
    want = {r[0]: (r[1] // 2, r[1] - r[1] // 2, r[1] // 2, 0) for r in rows if r[1]}
    told = lambda found: {r.row: (r.left_edited, r.right_edited, r.left_next, r.right_next) for r in found.collect()}
    first = fingerprint.attempted(df.drop("n"), 0)
    assert first.filter("stuck").count() < 6 and told(first.filter("NOT stuck")).items() <= want.items()
    assert told(fingerprint.differences(df.drop("n"))) == want
    # Far too small sketches stay stuck, and are made larger until they peel.
    monkeypatch.setattr(fingerprint, "CELLS_PER_KEY", 0.1)
    monkeypatch.setattr(fingerprint, "LEAST_SHARE", 4)
    monkeypatch.setattr(fingerprint, "SWEEPS", 2)
    small = fingerprint.attempted(df.drop("n"), 0)
    assert small.filter("stuck").count() >= 40 and told(small.filter("NOT stuck")).items() <= want.items()
    assert told(fingerprint.differences(df.drop("n"))) == want


def test_main_path_is_native(spark, folder):
    import re

    plan = fingerprint.compare(spark.read.parquet(f"{folder}/documents.parquet"))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_texts_without_line_ends_are_compared_by_parts(spark):
    sentences = [f"this is sentence number {i} of a text without any line end." for i in range(40)]
    words = [f"word{i * 7919 % 4_001}" for i in range(3_000)]  # no sentence ends
    texts = [" ".join(sentences), " ".join([*sentences[:20], "this one differs.", *sentences[21:]]), " ".join(words), " ".join([*words[:1_500], "other", *words[1_501:]]), "x" * 5_000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = {r.doc_id: r for r in fingerprint.compare(df).collect()}
    assert abs(out[1].near_next - 39 / 41) < 1e-9 and out[3].near_next > 0.98
    assert 0.3 < out[1].near_edited < 0.5 and out[4].near_next == 0
    assert found(fingerprint.compare(df)) == brute(df.collect())
