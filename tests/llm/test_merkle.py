import random
import zlib
from hashlib import sha256

import messy
import numpy as np
import pytest

import oracle_check
from copse.llm import catalog, merkle


def h(text):
    return sha256(text.encode()).hexdigest()


def told(*values):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def levels(nodes):
    """All levels of a tree, leaves first."""
    out = [nodes]
    while len(nodes) > 1:
        nodes = [h("".join(nodes[i : i + 2])) for i in range(0, len(nodes), 2)]
        out.append(nodes)
    return out


def beside(tree, at):
    out = []
    for nodes in tree[:-1]:
        run = nodes[at // 2 * 2 : at // 2 * 2 + 2]
        out.append((at % 2, run[1 - at % 2] if len(run) > 1 else ""))
        at //= 2
    return out


def expected(rows):
    groups: dict = {}
    for r in rows:
        changed = None if r.n_chars is None or r.doc_id is None or zlib.crc32(str(r.doc_id).encode()) % 7 else r.n_chars + 1
        leaf = told(r.doc_id, r.source, r.lang, r.n_chars, r.text)
        groups.setdefault(r.lang, []).append((r.doc_id, leaf, leaf if changed is None else told(r.doc_id, r.source, r.lang, changed, r.text)))
    langs = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    for lang in langs:
        groups[lang].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
    trees = {lang: levels([x[1] for x in groups[lang]]) for lang in langs}
    top = levels([trees[lang][-1][0] for lang in langs])
    out = []
    for g, lang in enumerate(langs):
        for at, (key, leaf, now) in enumerate(groups[lang]):
            steps = beside(trees[lang], at) + beside(top, g)
            for right, other in steps:
                now = h(other + now if right else now + other)
            out.append((key, leaf, trees[lang][-1][0], top[-1][0], h("".join(x for _, x in steps)), now, now == top[-1][0]))
    return sorted(out, key=repr)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_query_and_sql(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    want = expected(docs.collect())
    assert rows_of(catalog.op13_merkle_manifest(spark, folder)) == want
    assert any(not r[-1] for r in want) and any(r[-1] for r in want)
    result = oracle_check.compare(spark, oracle_check.connect(folder), folder, catalog.op13_merkle_manifest, catalog.SQL["op13_merkle_manifest"])
    assert result.startswith("ok"), result


@pytest.mark.parametrize("most", [1, 3, 10_000])
def test_messy(spark, most):
    df = messy.frame(spark)
    assert rows_of(merkle.verify(df, most)) == expected(df.collect())


def test_few_rows(spark):
    assert merkle.verify(messy.empty(spark)).count() == 0
    one = messy.frame(spark).filter("doc_id = 3").limit(1)
    assert rows_of(merkle.verify(one)) == expected(one.collect())
    assert merkle.verify(one).first().leaf == merkle.verify(one).first().root


@pytest.mark.parametrize("seed", range(3))
def test_blocks_of_nodes(spark, seed, monkeypatch):
    """Many small partitions and small blocks, so that nodes above the partitions take several rounds."""
    monkeypatch.setattr(merkle, "PARTS_PER_BLOCK", 1)
    rng = random.Random(seed)
    rows = [(i, "t" * rng.randint(0, 3), rng.choice([None, "en", "en", "en", "Ünï"]), None, rng.choice([None, 2**63 - 1, 5])) for i in range(rng.randint(50, 90))]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert rows_of(merkle.verify(df, 4)) == expected(df.collect())


@pytest.mark.parametrize("seed", range(5))
def test_missing_nodes_are_minimal(seed):
    """What is missing is not on the way up from the leaves, is next to it, and suffices for the root."""
    rng = random.Random(seed)
    n = rng.randint(1, 60)
    tree = levels([h(str(i)) for i in range(n)])
    own = np.array(sorted(rng.sample(range(n), rng.randint(1, n))))
    need = list(merkle.missing(own, n))
    assert len(need) == len(set(need))
    on_the_way = {(k, i >> k) for i in own.tolist() for k in range(len(tree))}
    assert not on_the_way & set(need) and all((k, i ^ 1) in on_the_way for k, i in need)
    found = merkle.levels_of({i: tree[0][i] for i in own.tolist()}, n, {(k, i): tree[k][i] for k, i in need})
    assert found[-1] == {0: tree[-1][0]}
    for i in own.tolist():
        assert merkle.proof(i, n, found) == [x for _, x in beside(tree, i)]
