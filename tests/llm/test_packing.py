import random
import zlib

import messy
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from copse.llm import catalog, packing


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def expected(library, rows):
    out: dict = {}
    for key, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids + [1]
        for at in range(0, len(ids), packing.WINDOW):
            part = ids[at : at + packing.WINDOW]
            row = (key, at, len(part), zlib.crc32(np.array(part, dtype="<u4").tobytes()), len(ids))
            out[row] = out.get(row, 0) + 1
    return out


def check_places(rows):
    by: dict = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= packing.WINDOW
    return by


COLUMNS = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]


def test_query(spark, folder, library):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    out = catalog.op8_packing(spark, folder).persist()
    assert messy.counted(out, COLUMNS) == expected(library, [(r.doc_id, r.text) for r in docs.collect()])
    by = check_places(out.collect())
    filled = sum(n for parts in by.values() for _, n in parts)
    assert filled > 0.97 * packing.WINDOW * len(by)


def test_messy(spark, library):
    df = messy.frame(spark)
    out = packing.pack(df)
    assert messy.counted(out, COLUMNS) == expected(library, [(r.doc_id, r.text) for r in df.collect()])
    check_places(out.collect())
    assert packing.pack(messy.empty(spark)).count() == 0


def test_small_store_of_words(monkeypatch, library):
    monkeypatch.setattr(packing, "CACHED_WORDS", 3)
    t = packing.Tokenizer()
    for text in messy.TEXTS[:19]:
        ids = np.frombuffer(t.encode(text), dtype="<u4").tolist()
        assert ids == library.encode(text or "", add_special_tokens=False).ids + [1]


def plain_best_fit(lengths, window):
    open_, where = [], []
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        fits = [(room, j) for j, room in enumerate(open_) if room >= lengths[i]]
        if fits:
            room = min(fits)[0]
            j = [k for r, k in fits if r == room][-1]
        else:
            open_.append(window)
            j = len(open_) - 1
        open_[j] -= lengths[i]
        where.append(open_[j])
    return len(open_), sorted(open_)


@pytest.mark.parametrize("seed", range(5))
def test_best_fit_equals_a_plain_search(seed):
    rng = random.Random(seed)
    window = rng.choice([10, 64, 100, 2048])
    lengths = np.array([rng.randint(1, window) for _ in range(400)])
    sequence, offset = packing.best_fit_decreasing(lengths, window)
    used = np.bincount(sequence, weights=lengths)
    assert used.max() <= window
    n, rooms = plain_best_fit(lengths.tolist(), window)
    assert len(used) == n and sorted((window - used).astype(int)) == rooms
    for s in range(n):
        at = 0
        for o, k in sorted(zip(offset[sequence == s], lengths[sequence == s])):
            assert o == at
            at += k


def test_sequences(spark, library):
    df = messy.frame(spark).filter("doc_id is not null").dropDuplicates(["doc_id"])
    packed = packing.pack(df)
    ids = {r.sequence_id: r.ids for r in packing.sequences(packed, df).collect()}
    texts = {r.doc_id: r.text or "" for r in df.collect()}
    for r in packed.collect():
        want = (library.encode(texts[r.doc_id], add_special_tokens=False).ids + [1])[r.start : r.start + r.length]
        assert ids[r.sequence_id][r.offset : r.offset + r.length] == want
    assert all(len(x) == packing.WINDOW or not len(x) & (len(x) - 1) for x in ids.values())
