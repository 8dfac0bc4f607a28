import messy
import pytest

from copse.llm import catalog, render

CASES = {
    "": "",
    "plain": "plain",
    "a  b\n c": "a b c",
    "<p>one<p>two": "one\n\ntwo",
    "<div>a<div>b</div>c</div>": "a\nb\nc",
    "a<br>b<br><br>c": "a\nb\n\nc",
    "x<script>var t='</p>';</script>y<style>p{}</style><!-- z -->": "xy",
    "<head><title>t</title></head><body>b</body>": "b",
    "<p hidden>a</p><p style='display: none'>b</p><p>c</p><template>d</template>": "c",
    "<ul><li>a<li>b<ul><li>c</ul><li>d</ul>": "- a\n- b\n  - c\n- d",
    "<ol start=9><li>x</li><li>y</li></ol>": "9. x\n10. y",
    "<dl><dt>t<dd>d<dt>u</dl>": "t\n    d\nu",
    "<blockquote>q<p>r</p></blockquote>": "> q\n\n> r",
    "<pre>a\n  b</pre>": "a\n  b",
    "<table><tr><th>n<th>value<tr><td>long name<td>1</table>": "n         | value\nlong name | 1",
    "<table><tr><td colspan=2>ab<tr><td>c<td>d</table>": "ab\nc | d",
    "<table><tr><td><table><tr><td>i<td>j</table><td>k</table>": "i | j | k",
    "<table><tr><td>a<br>b<td>c</table>": "a | c\nb |",
    "&lt;&amp;&copy;&#x41;": "<&©A",
    "<img alt='pic'> <a href='/x'>link</a>": "pic link",
    "a<hr>b": "a\n\n---\n\nb",
    "<b>bo<i>ld</b>er</i>": "bolder",
    "1 < 2 > 0": "1 < 2 > 0",
    "<p>unclosed <b": "unclosed",
    "<td>alone</td>": "alone",
}


@pytest.mark.parametrize("page", CASES)
def test_layout(page):
    assert render.render(page) == CASES[page]


def test_wide_letters_are_aligned():
    out = render.render("<table><tr><td>日本<td>x<tr><td>abcd<td>y</table>").split("\n")
    assert [render.width(line[: line.index("|")]) for line in out] == [5, 5]


def test_deep_and_broken_pages():
    assert render.render("<div>" * 50_000 + "x") == "x"
    assert render.render("<ul><li>" * 3_000 + "x").endswith("- x")
    assert render.render("<table><tr><td>" * 300 + "x").strip() == "x"
    assert render.render("</b>" * 50_000 + "<a '" * 50_000) == "" and render.render("<i>" * 20_000 + "</b>" * 20_000 + "x") == "x"
    for t in messy.TEXTS:
        render.render(t)
    assert render.render("<" * 10_000 + " a") == "<" * 10_000 + " a" and render.render("<!--" * 5_000) == ""


BROKEN = {
    '<p><img src="a.png"">Hello world <a href="b">link</a></p><p>after</p>': "Hello world link\n\nafter",
    "<p class=it's>Hello</p><p>don't go</p><p>z</p>": "Hello\n\ndon't go\n\nz",
    "<p>a<!-->b<p>c": "ab\n\nc",
    "<p>a<!--->b<p>c": "ab\n\nc",
    "<p>a<!-- x --!>b<p>c": "ab\n\nc",
    "<p>a</3>b</>c": "abc",
    "<a title='x > y' href=q/>z</a>": "z",
    "<img alt=first alt=second>": "first",
    "<img alt='a &amp; b'>": "a & b",
    '<p =x="hidden" hidden>a</p>b': "b",
    "a<plaintext><b>x</b> &amp;": "a\n<b>x</b> &amp;",
    "<ruby>漢<rp>(</rp><rt>kan</rt><rp>)</rp></ruby>": "漢kan",
    "<dialog>shut</dialog><dialog open>said</dialog>": "said",
}


@pytest.mark.parametrize("page", BROKEN)
def test_broken_pages_lose_nothing(page):
    assert render.render(page) == BROKEN[page]


def test_wide_cells_are_broken():
    words = " ".join(f"word{i}" for i in range(60))
    out = render.render(f"<table><tr><td>{words}<td>x<tr><td>a<td>b</table>").split("\n")
    assert all(render.width(line) <= render.CELL_WIDTH + 4 for line in out) and out[0].endswith("| x")
    assert " ".join(w for line in out[:-1] for w in line.split(" |")[0].split()) == words
    address = "x" * 300
    assert address in render.render(f"<table><tr><td>{address} y<td>z</table>")


@pytest.mark.parametrize("row", ["<tr><td rowspan=65534>x", "<tr><td colspan=1000>x<td>y", "<tr><td>x<td rowspan=9>y", "<tr>" + "<td>" * 40])
def test_hostile_tables_take_linear_time_and_room(row):
    import time

    def took(n):
        page = "<table>" + row * n
        began = time.process_time()
        out = render.render(page)
        assert len(out) <= 45 * len(page)
        return time.process_time() - began

    small, large = max(took(2_000), 0.02), took(16_000)
    assert large < 24 * small
    page = "<table><tr><td>" + "w " * 10_000 + "<td>z" + "<tr><td>a<td>b" * 2_000
    assert len(render.render(page)) < 20 * len(page)


WHOLE = {
    "<table><thead><th>A<th>B</thead><tbody><td>x<td>y</table>": "A | B\nx | y",
    "<table><td>x</td></table>": "x",
    "<table><tr><form><td>x</td></form></tr></table>": "x",
    "<table><tr>lost<td>x</tr></table>": "lost\n\nx",
    "<table><tbody>a<tr><div>b</div><td>x</td><b>c</b><td>y</table>z": "a\nb\nc\n\nx | y\n\nz",
    "<table><tr><table><tr><td>x</table>": "x",
    "<table><tr><td rowspan=2>a<td>b<tr><td>c<tr><td>d<td>e</table>": "a | b\n  | c\nd | e",
    "<table><tr><td>a<td rowspan=0>b<tr><td>c<tr><td>d</table>": "a | b\nc |\nd |",
    "<p>a <math><mi>x</mi><mo>=</mo><mn>1</mn><annotation>tex</annotation></math>": "a x=1",
    "<svg><defs/><title/><desc>d</desc><text>one</text><text>two</text></svg> b": "one two b",
    "<script>for (i = 0; i <n; i++) { // don't\n}</script><p>shown<p title='x'>more": "shown\n\nmore",
}


@pytest.mark.parametrize("page", WHOLE)
def test_nothing_shown_is_lost(page):
    assert render.render(page) == WHOLE[page]


def test_large_tables_are_aligned():
    lines = render.render("<table>" + "<tr><td>a<td>b" * 60_000 + "<tr><td>long<td>c</table>").split("\n")
    assert len(lines) == 60_001 and set(lines[:-1]) == {"a    | b"} and lines[-1] == "long | c"


def words_shown(page):
    """The words of a page by a plain rule: everything outside tags but for scripts and the like."""
    import html
    import re

    page = re.sub(r"(?s)<!--.*?-->|<(script|style|head)\b.*?</\1>", " ", page)
    return re.findall(r"\w+", html.unescape(re.sub(r"(?s)<[^>]*>", " ", page)))


def test_query_shows_every_visible_word(spark, folder):
    import re

    pages = {r.page_id: r.html for r in spark.read.parquet(f"{folder}/pages.parquet").collect()}
    out = catalog.op7_html_text(spark, folder).collect()
    assert sorted(r.page_id for r in out) == sorted(pages)
    for r in out:
        assert "".join(re.findall(r"\w+", r.text)) == "".join(words_shown(pages[r.page_id]))
        assert r.n_lines == len(r.text.split("\n"))


def test_messy_table(spark):
    df = messy.frame(spark)
    out = render.extract(df, "doc_id", "text")
    assert out.count() == df.count() and not out.filter("text is null").count()
    assert render.extract(messy.empty(spark), "doc_id", "text").count() == 0
