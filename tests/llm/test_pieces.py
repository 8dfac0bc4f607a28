import random
import re

import messy
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F

from copse.llm import catalog, pieces


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def test_encode_equals_the_library_and_decodes(spark, folder, library):
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").unionByName(messy.frame(spark).select((F.col("doc_id") + 10_000_000).alias("doc_id"), "text"))
    texts: dict = {}
    for r in docs.collect():
        texts.setdefault(r.doc_id, []).append(r.text or "")
    got = pieces.encode(docs)
    rows = got.collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert list(r.ids) in [library.encode(t) for t in texts[r.doc_id]], r.doc_id
    for r in pieces.decode(got).collect():
        assert r.text in texts[r.doc_id]


def test_query(spark, folder):
    out = catalog.op3_sentencepiece(spark, folder)
    assert out.filter("n_ids <> size(ids)").count() == 0 and out.count() == spark.read.parquet(f"{folder}/documents.parquet").count()


def test_empty_and_hot_word(spark, library):
    assert pieces.encode(messy.empty(spark)).count() == 0
    df = spark.range(500).select(F.col("id").alias("doc_id"), F.lit("same same same").alias("text"))
    assert {tuple(r.ids) for r in pieces.encode(df).collect()} == {tuple(library.encode("same same same"))}


def test_decode_of_no_utf8(spark):
    byte = pieces.Vocabulary().bytes
    df = spark.createDataFrame([(1, [byte[0xFF], byte[65]]), (2, None), (3, [])], "doc_id long, ids array<int>")
    assert {r.doc_id: r.text for r in pieces.decode(df).collect()} == {1: "�A", 2: "", 3: ""}


def best_score(text, table, low, longest):
    """The best of all ways to cut a text, end by end; a character without piece costs ``low``."""
    best = [0.0]
    for stop in range(1, len(text) + 1):
        ways = [best[a] + table[text[a:stop]] for a in range(max(0, stop - longest), stop) if text[a:stop] in table]
        if text[stop - 1] not in table:
            ways.append(best[stop - 1] + low)
        best.append(max(ways))
    return best[-1]


def check_best(rows, texts):
    """The path spells its text, adds up to its score, and no path has a larger sum."""
    vocabulary = pieces.Vocabulary()
    table = {p: s for p, _, s in vocabulary.rows}
    score = {i: s for _, i, s in vocabulary.rows}
    low = min(table.values()) - 10
    for r in rows:
        marked = "▁" + texts[r.doc_id].replace(" ", "▁") if texts[r.doc_id] else ""
        spelled = b"".join(vocabulary.spelling[i] for i in r.best_ids).decode()
        assert spelled.replace(" ", "▁") == marked
        known = [i for i in r.best_ids if i in score]
        unknown = len(spelled) - sum(len(vocabulary.spelling[i].decode()) for i in known)
        assert abs(sum(score[i] for i in known) + low * unknown - r.best_score) < 1e-6 * (1 + abs(r.best_score))
        assert abs(best_score(marked, table, low, vocabulary.longest) - r.best_score) < 1e-6 * (1 + abs(r.best_score))


def test_viterbi_equals_brute_force(spark):
    words = ["the", "bleation", "hänsel", "日本", "x", "  ab", "erthhea", "zzzz", "a" * 60, "größe" * 12]
    df = spark.createDataFrame(list(enumerate(words)), "doc_id long, text string")
    check_best(pieces.encode(df).collect(), dict(enumerate(words)))


def test_viterbi_of_the_query(spark, folder):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    check_best(catalog.op3_sentencepiece(spark, folder).collect(), texts)


def test_many_blocks(spark, monkeypatch):
    df = messy.frame(spark).filter("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    one = {r.doc_id: (r.ids, r.best_ids) for r in pieces.encode(df).collect()}
    monkeypatch.setattr(pieces, "BLOCK_BYTES", 20_000)
    assert {r.doc_id: (r.ids, r.best_ids) for r in pieces.encode(df).collect()} == one


def test_query_decodes_to_the_texts(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    out = catalog.op3_sentencepiece(spark, folder)
    assert out.columns == ["doc_id", "ids", "best_ids", "best_score", "n_ids", "decoded"]
    assert {r.doc_id: r.decoded for r in out.collect()} == {r.doc_id: r.text or "" for r in docs.collect()}
    assert pieces.with_decoded(pieces.encode(messy.frame(spark)).withColumn("n_ids", F.size("ids"))).count() == messy.frame(spark).count()


def test_query_moves_no_rows(spark, folder):
    """Texts and words moved to meet took more disk than the query may."""
    plan = catalog.op3_sentencepiece(spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "Exchange" not in plan and plan.count("Scan") == 1


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.Vocabulary()


def odd_words(vocabulary, n):
    draw = random.Random(7)
    known = [p for p, _, _ in vocabulary.rows]
    alphabet = [*"aeinrst▁", "é", "ß", "日", "語", "😀", "\U0010ffff", "\0", "\n"]
    some = lambda: draw.choice(known) if draw.random() < 0.4 else "".join(draw.choices(alphabet, k=draw.randint(1, 6)))
    return sorted({"".join(some() for _ in range(draw.randint(1, 6))) for _ in range(n)}, key=len)


def test_words_at_once_equal_words_one_by_one(vocabulary):
    words, known = odd_words(vocabulary, 3_000), pieces.Words(vocabulary)
    score, both = known._fold(words, np.array([len(w) for w in words]))
    apart = [known._fold_long(w) for w in words]
    assert score.tolist() == [float(s[0]) for s, _ in apart]
    for k in (0, 1):
        ids, counts = both[k]
        assert counts.tolist() == [int(two[k][1][0]) for _, two in apart]
        assert ids.tolist() == [i for _, two in apart for i in two[k][0].tolist()]


def test_words_around_the_limit(vocabulary, library):
    draw = random.Random(11)
    known = [p for p, _, _ in vocabulary.rows if "▁" not in p]
    texts = ["".join(draw.choices(known, k=pieces.LONG_WORD))[: pieces.LONG_WORD + d] for d in (-2, -1, 0, 1)]
    assert pieces.Words(vocabulary).of_texts(pa.array(texts))[0].to_pylist() == [library.encode(t) for t in texts]


def test_words_of_texts(vocabulary):
    draw = random.Random(3)
    texts = ["".join(draw.choices("ab ▁\n日", weights=[4, 2, 5, 3, 1, 1], k=draw.randint(1, 40))) for _ in range(2_000)] + [" ", "▁", " " * 9, "▁" * 8, None]
    cut = [re.findall("▁*[^▁]+|▁+", "▁" + t.replace(" ", "▁")) if t else None for t in texts]
    assert pieces._words(pa.array(texts)).to_pylist() == cut


def test_store_is_emptied(vocabulary, library, monkeypatch):
    monkeypatch.setattr(pieces, "KNOWN_CHARS", 200)
    monkeypatch.setattr(pieces, "FOLDED_CHARS", 64)
    texts = [t or None for t in messy.TEXTS if t != messy.LONG] * 2
    known = pieces.Words(vocabulary)
    for text in texts:
        ids, _, _ = known.of_texts(pa.array([text, None], type=pa.string()))
        assert ids.to_pylist() == [library.encode(text or ""), []]
        assert known.chars <= 200 + 2 * len(text or "") + 2


def test_decode_of_any_bytes(spark, vocabulary):
    draw = random.Random(5)
    some = vocabulary.bytes[0x20:0x22] + vocabulary.bytes[0x70:] + [0, 259, 300]
    rows = [(k, draw.choices(some, k=draw.randint(0, 9))) for k in range(3_000)]
    plain = lambda ids: b"".join(vocabulary.spelling[i] for i in ids).removeprefix(b" ").decode("utf-8", "replace")
    got = pieces.decode(spark.createDataFrame(rows, "doc_id long, ids array<int>"))
    assert {r.doc_id: r.text for r in got.collect()} == {k: plain(ids) for k, ids in rows}
