import itertools
import random
import zlib

import messy
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from copse.llm import catalog, packing, slack

COLUMNS = ["doc_id", "piece", "start", "length", "ids_crc32"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def expected(library, rows):
    out: dict = {}
    for key, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids + [2]
        over = len(ids) % slack.LIMIT or slack.LIMIT
        starts = [0, *range(over, len(ids), slack.LIMIT)]
        for i, at in enumerate(starts):
            part = ids[at : starts[i + 1] if i + 1 < len(starts) else len(ids)]
            row = (key, i, at, len(part), zlib.crc32(np.array(part, dtype="<u4").tobytes()))
            out[row] = out.get(row, 0) + 1
    return out


def sequences(rows):
    by: dict = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= slack.LIMIT
    return by


def test_query(spark, folder, library):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    out = catalog.op11_best_fit_packing(spark, folder).persist()
    assert messy.counted(out, COLUMNS) == expected(library, [(r.doc_id, r.text) for r in docs.collect()])
    by = sequences(out.collect())
    tokens = sum(n for parts in by.values() for _, n in parts)
    assert len(by) <= tokens / slack.LIMIT * 1.01 + 1


def test_messy(spark, library):
    df = messy.frame(spark)
    out = slack.pack(df)
    assert messy.counted(out, COLUMNS) == expected(library, [(r.doc_id, r.text) for r in df.collect()])
    sequences(out.collect())
    assert slack.pack(messy.empty(spark)).count() == 0


def test_several_groups(spark, monkeypatch):
    monkeypatch.setattr(slack, "GROUP_PIECES", 7)
    df = messy.frame(spark)
    rows = slack.pack(df).collect()
    by = sequences(rows)
    assert len(by) > 3 and len(rows) >= df.count()


@pytest.mark.parametrize("seed", range(30))
def test_fullest_equals_trying_all(seed):
    rng = random.Random(seed)
    items = [rng.randint(1, 40) * rng.choice([1, 1, 3]) for _ in range(rng.randint(0, 10))]
    room = rng.randint(0, 150)
    counts: dict = {}
    for x in items:
        counts[x] = counts.get(x, 0) + 1
    taken = slack.fullest(counts, room)
    assert all(n <= counts[k] for k, n in taken.items())
    best = max(sum(c) for k in range(len(items) + 1) for c in itertools.combinations(items, k) if sum(c) <= room)
    assert sum(k * n for k, n in taken.items()) == best


@pytest.mark.parametrize("seed", range(8))
def test_each_sequence_is_the_fullest(seed):
    """Sequences in order equal a plain search that takes them one by one, and best fit needs no fewer."""
    rng = random.Random(seed)
    limit = rng.choice([12, 50, 100])
    lengths = np.array([rng.randint(1, limit) for _ in range(rng.randint(0, 120))], dtype=np.int64)
    number, offset = slack.least_slack(lengths, limit)
    left, filled = sorted(lengths.tolist(), reverse=True), []
    while left:
        first = left.pop(0)
        sums = {0: []}
        for i, x in enumerate(left):
            for s, way in list(sums.items()):
                if s + x <= limit - first and s + x not in sums:
                    sums[s + x] = [*way, i]
        best = max(sums)
        filled.append(first + best)
        sequence = number[np.flatnonzero(lengths == first)]
        chosen = [int(x) for x in lengths[number == len(filled) - 1]]
        assert sum(chosen) == filled[-1] and max(chosen) == first and len(sequence)
        for x in chosen:
            if x == first and first in chosen:
                chosen.remove(first)
                break
        for x in chosen:
            left.remove(x)
    for s in range(len(filled)):
        at = 0
        for o, k in sorted(zip(offset[number == s], lengths[number == s])):
            assert o == at
            at += k
    if len(lengths):
        assert len(filled) <= len(np.unique(packing.best_fit_decreasing(lengths, limit)[0]))


def test_few_searches(monkeypatch):
    """Equal sequences are taken together: as many searches as there are lengths, whatever the number of pieces."""
    calls = []
    plain = slack.fullest
    monkeypatch.setattr(slack, "fullest", lambda *a: calls.append(1) or plain(*a))
    lengths = np.random.default_rng(0).integers(1, slack.LIMIT, 60_000)
    number, _ = slack.least_slack(lengths)
    used = np.bincount(number, weights=lengths)
    assert used.max() <= slack.LIMIT and len(calls) <= len(np.unique(lengths))
    assert len(used) <= lengths.sum() / slack.LIMIT * 1.01 + 1
