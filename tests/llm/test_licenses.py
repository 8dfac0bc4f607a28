import re

import messy
import pytest

from copse.llm import catalog, licenses


def brute(text):
    found = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", messy.lower(text or ""))
    places, labels = [], set()
    for phrase, label in licenses.BASE.items():
        p = phrase.split()
        for i in range(len(found)):
            if found[i : i + len(p)] == p:
                places.append(i)
                labels.add(label)
    return len(found), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


@pytest.mark.parametrize(
    ("text", "written", "names"),
    [
        ("MIT", "mit", "mit"),
        ("MIT OR Apache-2.0", "mit | apache-2.0", "mit apache-2.0"),
        ("MIT AND (BSD-3-Clause OR Zlib)", "mit & (bsd-3-clause | zlib)", "mit bsd-3-clause zlib"),
        ("a or b and c", "a | b & c", "a b c"),
        ("(c or a) and b", "b & (c | a)", "a b c"),
        ("c and b and a and b", "a & b & c", "a b c"),
        ("a or b or a", "a | b", "a b"),
        ("a and a", "a", "a"),
        ("a or (b or c)", "a | b | c", "a b c"),
        ("(b or c) and (b or d) or e", "(b | c) & (b | d) | e", "b c d e"),
        ("GPL-2.0 WITH Classpath-exception-2.0 or mit", "gpl-2.0 with classpath-exception-2.0 | mit", "gpl-2.0 mit"),
        ("(a or b) with e", "(a | b) with e", "a b"),
        ("mit */ trailing", "mit", "mit"),
        ("((a))", "a", "a"),
    ],
)
def test_expressions(text, written, names):
    assert licenses.evaluate(licenses.parse(text.lower())) == (written, set(names.split()))


def truth(written, held):
    """The value of an expression, where some licences are met."""
    tokens = re.findall(r"[()|&]|[^()|& ]+", written)
    return eval(" ".join({"|": "or", "&": "and"}.get(t, t if t in "()" else str(t in held)) for t in tokens))


@pytest.mark.parametrize("seed", range(20))
def test_value_is_that_of_the_text(seed):
    import random

    rng = random.Random(seed)

    def make(depth):
        if not depth or rng.random() < 0.2:
            return rng.choice("abcde")
        return f"({make(depth - 1)} {rng.choice(['and', 'or'])} {make(depth - 1)})"

    text = make(5)
    written, names = licenses.evaluate(licenses.parse(text))
    for k in range(32):
        held = {x for i, x in enumerate("abcde") if k >> i & 1}
        plain = eval(re.sub(r"\b[a-e]\b", lambda m: str(m[0] in held), text))
        assert truth(written, held) == plain
    assert names == set(re.findall(r"\b[a-e]\b", text))


@pytest.mark.parametrize("text", ["", "or mit", "mit and", "(mit", "()", ")", "and"])
def test_no_expression(text):
    assert licenses.parse(text) is None


def test_any_number_of_alternatives():
    many = " or ".join(f"a{i}" for i in range(500))
    assert licenses.evaluate(licenses.parse(many))[0] == many.replace("or", "|")
    both = " and ".join(f"(a{i} or b{i})" for i in range(200))
    assert licenses.evaluate(licenses.parse(both))[0] == both.replace("or", "|").replace("and", "&")
    deep = "a and (b or (" * 20_000 + "c" + "))" * 20_000
    assert licenses.evaluate(licenses.parse(deep))[0].count("(") == 20_000


@pytest.mark.parametrize("unit", ["spdx-license-identifier: mit or gpl-2.0 x ", "under the mit license ", "spdx-license-identifier: (", "spdx-license-identifier: a and "])
def test_long_lines_take_linear_time(unit):
    import time

    scanner = licenses.Scanner()

    def took(n):
        began = time.process_time()
        scanner.scan(unit * n)
        return time.process_time() - began

    assert took(40_000) < 30 * max(took(5_000), 0.02)


def labels_of(text):
    """Labels of notices, found in the words one by one, and of the names behind tags, up to the first that no operator joins."""
    lower = messy.lower(text or "")
    found = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
    out = {label for p, label in {**licenses.BASE, **licenses.NOTICES}.items() if any(found[i : i + len(p.split())] == p.split() for i in range(len(found)))}
    for rest in re.findall(r"spdx-license-identifier:([^\n]*)", lower):
        m = re.match(r"[^()a-z0-9]*[(]*([a-z0-9][a-z0-9.+-]*)((?:[^a-z0-9()]+(?:and|or)[^a-z0-9()]+[(]*[a-z0-9][a-z0-9.+-]*[)]*)*)", rest)
        if m:
            out |= {licenses.IDENTIFIERS.get(x, x) for x in re.findall(r"[a-z0-9][a-z0-9.+-]*", m[0]) if x not in licenses.PRECEDENCE}
    return ",".join(sorted(out))


def test_messy_and_query(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for df in (messy.frame(spark), docs):
        want = {}
        for r in df.collect():
            key = (r.doc_id, *brute(r.text))
            want[key] = want.get(key, 0) + 1
        got = licenses.scan(df)
        assert messy.counted(got, ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels"]) == want
        texts = {r.doc_id: r.text for r in df.collect() if r.doc_id is not None}
        for r in got.collect():
            assert r.doc_id is None or r.labels == labels_of(texts[r.doc_id])
            assert 0 <= r.score <= 1 and set(r.base_labels.split(",")) - {""} <= set(r.labels.split(","))
    assert licenses.scan(messy.empty(spark)).count() == 0
    assert catalog.op5_license_scan(spark, folder).count() == docs.count()


def test_tags(spark):
    text = "// SPDX-License-Identifier: MIT OR GPL-3.0-only\nx; spdx-license-identifier: (\ny"
    df = spark.createDataFrame([(1, text), (2, "GNU General Public License, version 3"), (3, "spdx-license-identifier: or")], "doc_id long, text string")
    a, b, c = sorted(licenses.scan(df).collect())
    assert (a.labels, a.base_labels, a.score, a.expressions) == ("gpl-3,mit", "", 1.0, ["mit | gpl-3.0-only"])
    assert (b.labels, b.score) == ("gpl-3", 0.5) and (c.labels, c.score) == ("", 0.0)
