import random

import messy
import pytest
from pyspark.sql import functions as F

from copse.llm import catalog, jaccard


def shingle_set(text):
    w = messy.words(messy.lower(text or ""))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def brute(rows):
    """All pairs; rows with words are linked or not, and each component is named by its smallest id."""
    sets = [shingle_set(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                parent[find(i)] = find(j)
    least: dict = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            least[find(i)] = min(key, least.get(find(i), key))
    out: dict = {}
    for i, (key, _) in enumerate(rows):
        row = (key, len(sets[i]), least.get(find(i)) if sets[i] else key)
        out[row] = out.get(row, 0) + 1
    return out


COLUMNS = ["doc_id", "n_shingles", "component_id"]


def chains(seed, n=260):
    """Short and long texts, each some edits from an earlier one, so that links form chains, stars and groups; some with a common passage."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    passage = [rng.choice(words) for _ in range(30)]
    texts = []
    for i in range(n):
        kind = rng.random()
        if i < 8 or kind < 0.2:
            t = [rng.choice(words) for _ in range(rng.choice([3, 5, 6, 7, 8, 9, 12, 20, 45, 120]))]
        else:
            t = list(rng.choice(texts[-40:]))
            for _ in range(rng.choice([0, 1, 1, 2, 4])):
                t[rng.randrange(len(t))] = rng.choice(words)
            if kind > 0.9:
                t = t[: len(t) // 2 + 1] + passage + t[len(t) // 2 + 1 :]
        texts.append(t)
    return [(1000 - 3 * i, " ".join(t)) for i, t in enumerate(texts)]


@pytest.mark.parametrize(("seed", "light", "salt"), [(1, 40, 200_000), (2, 2, 3), (3, 12, 3), (4, 40, 200_000)])
def test_equals_all_pairs(spark, monkeypatch, seed, light, salt):
    monkeypatch.setattr(jaccard, "SALT_ROWS", salt)
    monkeypatch.setattr(jaccard, "choose_boundary", lambda _: light)
    if salt == 3:
        monkeypatch.setattr(jaccard, "MAX_BROADCAST_IDS", 0)
    rows = chains(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert messy.counted(jaccard.component_table(df), COLUMNS) == brute(rows)


def test_messy(spark):
    df = messy.frame(spark)
    rows = [(r.doc_id, r.text) for r in df.collect()]
    assert messy.counted(jaccard.component_table(df), COLUMNS) == brute(rows)
    assert jaccard.component_table(messy.empty(spark)).count() == 0


def test_bits_bound_the_difference():
    import numpy as np

    rng = np.random.default_rng(0)
    for n in (1, 3, 20, 500, 4_000):
        for other in (1, n, 2 * n):
            a = rng.integers(0, 1 << 63, n).astype(np.uint64)
            b = np.concatenate([a[: n // 2], rng.integers(0, 1 << 63, other).astype(np.uint64)])
            assert jaccard.least_difference(jaccard.parity_bits(np.unique(a)), jaccard.parity_bits(np.unique(b))) <= len(np.setxor1d(a, b))


def test_one_id_for_several_texts(spark):
    rows = [(1, "a b c d e f g h"), (1, "p q r s t u v w"), (2, "a b c d e f g h"), (3, "p q r s t u v w x"), (None, "p q r s t u v w x y")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert messy.counted(jaccard.component_table(df), COLUMNS) == brute(rows)


def test_large_group_of_near_copies_costs_no_pairs(spark):
    """A hub, a thousand copies that differ from it in one place each: one component, and no more links than a few for each."""
    base = [f"w{i}" for i in range(150)]
    rows = [(i, " ".join([*base[: 7 + i % 140], f"x{i}", *base[8 + i % 140 :]])) for i in range(1, 1001)] + [(0, " ".join(base))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out, links = jaccard.join_groups(df)
    assert {r.component_id for r in out.collect()} == {0}
    assert links.count() < 20_000


def test_long_chain_of_components(spark):
    edges = spark.range(300).select(F.xxhash64("id").alias("a"), F.xxhash64(F.col("id") + 1).alias("b"))
    out = jaccard.components(spark, edges)
    assert out.select("component").distinct().count() == 1 and out.count() == 300


def test_query_and_filter(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    want = brute([(r.doc_id, r.text) for r in docs.collect()])
    got = catalog.op6_ngram_jaccard(spark, folder)
    assert got.columns == COLUMNS and messy.counted(got) == want
    kept = jaccard.keep_one(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {key[2] for key in want} and kept.count() == len({key[2] for key in want})


def test_filter_messy(spark):
    df = messy.frame(spark)
    kept = [(r.doc_id, r.text) for r in jaccard.keep_one(df).collect()]
    want = brute([(r.doc_id, r.text) for r in df.collect()])
    with_words = {key[2] for key in want if key[1]}
    assert sorted(k for k, t in kept if shingle_set(t)) == sorted(with_words)
    assert len([k for k, t in kept if not shingle_set(t)]) == sum(n for key, n in want.items() if not key[1])


def test_filter_keeps_unlinked_texts_without_id_or_under_one(spark):
    far = [" ".join(f"t{i}w{j}" for j in range(12)) for i in range(5)]
    near = far[0] + " more"
    rows = [(None, t) for t in far] + [(None, near), (None, far[1]), (7, "p q r s t u v w"), (7, "k l m n o p q r"), (7, "k l m n o p q r s"), (8, "p q r s t u v w")]
    rows += [((1 << 60) + 1, "big one of many words"), ((1 << 60) + 3, "big two of many words"), (9, None), (None, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    kept = [(r.doc_id, r.text) for r in jaccard.keep_one(df).collect()]
    assert len(kept) == 11 and {k for k, _ in kept} == {None, 7, 9, (1 << 60) + 1, (1 << 60) + 3}
    texts = {t for _, t in kept}
    assert set(far[1:]) | {"p q r s t u v w"} <= texts
    assert len(texts & {far[0], near}) == 1 and len(texts & {"k l m n o p q r", "k l m n o p q r s"}) == 1
