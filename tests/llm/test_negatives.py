import math
import random

import numpy as np
import pytest

import oracle_check
from copse.llm import catalog, negatives

SCHEMA = "vec_id long, embedding array<double>, label int, score string, anchor_id long"


def expected(rows):
    """Every score written out, in Python integers."""
    part = []
    for i, r in enumerate(rows):
        key, vector, label = r[0], r[1], r[2]
        if label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        part.append((key, (label + 1) % 10 if key is not None and key % 7 == 0 else label, [math.floor(256 * x) for x in vector], i))
    out = []
    for a in part:
        if a[0] is None or a[0] % 50:
            continue
        scored = [(max(-negatives.LARGEST, min(negatives.LARGEST, sum(x * y for x, y in zip(a[2], b[2])))), b) for b in part if b is not a]
        scored.sort(key=lambda x: (-x[0], x[1][0] is None, x[1][0] or 0, x[1][3]))
        for score, p in [x for x in scored if x[1][1] == a[1]][:5]:
            fit = [x for x in scored if x[1][1] != a[1] and 50 * score <= 100 * x[0] <= 95 * score][:3]
            out += [(a[0], p[0], k + 1, n[0], score, s) for k, (s, n) in enumerate(fit)]
    return sorted(out, key=repr)


def result(df):
    return sorted((tuple(r) for r in negatives.mine(df).collect()), key=repr)


def test_query_and_sql(spark, folder):
    rows = spark.read.parquet(f"{folder}/embeddings.parquet").collect()
    got = sorted((tuple(r) for r in catalog.op12_hard_negatives(spark, folder).collect()), key=repr)
    assert got == expected(rows) and got
    told = oracle_check.compare(spark, oracle_check.connect(folder), folder, catalog.op12_hard_negatives, catalog.SQL["op12_hard_negatives"])
    assert told.startswith("ok"), told


def frame(spark, rows, partitions=1):
    return spark.createDataFrame([(*r, "clash", -1) for r in rows], SCHEMA).coalesce(partitions)


@pytest.mark.parametrize("seed", range(3))
def test_small_blocks_and_ties(spark, seed, monkeypatch):
    monkeypatch.setattr(negatives, "ROW_BLOCK", 7)
    monkeypatch.setattr(negatives, "ANCHOR_BLOCK", 2)
    rng = random.Random(seed)
    vectors = [[rng.choice([0.0, 0.25, 0.5, -0.25, 1.0]) for _ in range(3)] for _ in range(12)]
    ids = rng.sample(range(-200, 400), 90) + [0, 50, 100, 350]
    rows = [(i, rng.choice(vectors), rng.choice([0, 0, 0, 1, 2])) for i in dict.fromkeys(ids)]
    assert result(frame(spark, rows)) == expected(rows)


def test_messy(spark):
    inf, nan = float("inf"), float("nan")
    one = [0.5, 0.5]
    rows = [
        (0, one, 1), (50, one, 1), (50, one, 1), (100, [1.0], 1), (150, [], 1), (None, one, 1), (None, [0.3, 0.4], 2), (1, None, 1), (2, [None, 1.0], 1),
        (3, [inf, 1.0], 1), (4, [nan, 1.0], 1), (5, one, None), (6, [0.4, 0.4], 2), (7, [0.4, 0.4], 2), (8, [0.25, 0.5], 2), (8, [0.25, 0.5], 2),
        (200, [1e17, 1.0], 1), (9, [1e17, 0.5], 1), (10, [6e16, 0.5], 2), (250, [0.0, 0.0], 1), (11, [-1.0, -1.0], 2), (300, [1e300, 0.0], 1), (12, [1e30, 7.0], 2),
    ]
    assert result(frame(spark, rows)) == expected(rows)
    assert result(frame(spark, [])) == []
    assert result(frame(spark, [(0, one, 1)])) == []


def test_keys_sort_as_their_parts():
    class Record:
        def __init__(self, *values):
            self.anchor, self.score, self.kind, self.no_id, self.id, self.row, self.anchor_id = *values, None

    rng = random.Random(1)
    big = negatives.LARGEST
    some = [(rng.choice([0, 5, 2**40]), rng.choice([-big, -1, 0, 7, big]), rng.choice([0, 1]), rng.choice([0, 1]), rng.choice([-(2**63), -1, 0, big]), i) for i in range(300)]
    by_key = sorted(some, key=lambda x: negatives.packed(Record(*x))[0])
    assert by_key == sorted(some, key=lambda x: (x[0], -x[1], *x[2:]))


@pytest.mark.parametrize("seed", range(4))
def test_leading_and_inner(seed):
    rng = np.random.default_rng(seed)
    a, b = rng.integers(-3, 4, (6, 3)).astype(float), rng.integers(-3, 4, (40, 3)).astype(float)
    a[0, 0] = 2.0**60 if seed % 2 else 1.0
    scores = negatives.inner(a, b)
    assert scores.tolist() == [[max(-negatives.LARGEST, min(negatives.LARGEST, sum(int(x) * int(y) for x, y in zip(u, v)))) for v in b] for u in a]
    allowed = rng.random(scores.shape) < 0.3
    line, column = negatives.leading(scores, allowed, 4)
    want = [(i, j) for i in range(6) for j in sorted(np.flatnonzero(allowed[i]).tolist(), key=lambda j: (-scores[i, j], j))[:4]]
    assert list(zip(line.tolist(), column.tolist())) == want
