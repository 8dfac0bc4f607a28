"""Visible text of HTML pages, laid out as a text browser would.

A tokenizer feeds a tree builder that closes tags the way browsers imply it; rules of visibility drop what is not shown; a renderer then
walks the tree: blocks are set apart, lists get bullets or numbers and indents, preformatted text keeps its line ends, and the cells of tables are
aligned in columns. Each page is handled on its own, without recursion, so deep nesting is no limit.
"""

from __future__ import annotations

import html as entities
import itertools
import re
import unicodedata
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Element names of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
HIDDEN = frozenset("head script style template noscript title meta link iframe object datalist audio video canvas noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html legend li main menu nav ol optgroup option p plaintext pre search section summary table tbody td tfoot th thead tr ul".split()
)
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre table ul ol dl figure".split())
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header "
    "hgroup hr main menu nav ol p plaintext pre search section summary table ul li dd dt".split()
)
SCOPE = frozenset("html body table td th caption template".split())
# An opening tag closes an open element of the second set, unless one of the third set stands between.
IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"} | SCOPE),
    "dt": ({"dt", "dd"}, {"dl"} | SCOPE),
    "dd": ({"dt", "dd"}, {"dl"} | SCOPE),
    "option": ({"option"}, {"select", "datalist"} | SCOPE),
    "optgroup": ({"option", "optgroup"}, {"select"} | SCOPE),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tr": ({"tr", "caption", "colgroup"}, {"table"}),
    "tbody": ({"tbody", "thead", "tfoot", "caption", "colgroup"}, {"table"}),
    "thead": ({"tbody", "thead", "tfoot", "caption", "colgroup"}, {"table"}),
    "tfoot": ({"tbody", "thead", "tfoot", "caption", "colgroup"}, {"table"}),
    "body": ({"head"}, {"body"}),
}
# Parts of a table, each with those that it may stand in; what is neither a part nor may stand in one goes before the table.
PARTS = frozenset("table tbody thead tfoot tr".split())
PART_IN = {
    **dict.fromkeys(("td", "th"), PARTS), "tr": PARTS - {"tr"},
    **dict.fromkeys(("tbody", "thead", "tfoot", "caption", "colgroup", "col"), frozenset({"table"})),
}
STAYS = frozenset(PART_IN) | {"script", "style", "template"}
# Of drawings and formulas, what is not shown.
UNSHOWN = {
    "svg": frozenset("defs desc metadata symbol clippath lineargradient radialgradient pattern marker mask filter".split()),
    "math": frozenset({"annotation", "annotation-xml"}),
}

# A quote opens a value only right after an equals sign; anywhere else it is part of a name, as the standard has it.
_VALUE = r"\s*=\s*(?:\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z)|[^\s>\"'][^\s>]*)?"
_TAG = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))|<!\[CDATA\[(.*?)(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|</(?![a-zA-Z])[^>]*(?:>|\Z)"
    rf"|<(/?)([a-zA-Z][^\s/>]*)((?:[\s/]++|=?[^\s/>=]++(?:{_VALUE})?|=)*+)(?:>|\Z)", re.S)
_ATTR = re.compile(r"(=?[^\s/>=]+)(?:\s*=\s*(?:\"([^\"]*)\"?|'([^']*)'?|([^\s>\"'][^\s>]*))?)?")
_SPACE = re.compile(r"[ \t\n\r\f]+")
_UNSEEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*(?:hidden|collapse)", re.I)
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])", re.I) for name in RAW}
_BARE_VALUE = re.compile(r"=\s*[^\s\"'>]+\Z")


class Element:
    __slots__ = ("attrs", "children", "name")

    def __init__(self, name: str, attrs: dict[str, str]):
        self.name, self.attrs, self.children = name, attrs, []


def _attrs(text: str) -> dict[str, str]:
    """Names and values; of a name's several values the first counts."""
    found = _ATTR.findall(text) if text.strip() else []
    return {m[0].lower(): entities.unescape(m[1] or m[2] or m[3]) for m in reversed(found)}


def tree(page: str) -> Element:
    """The element tree of a page; any text has one."""
    root = Element("html", {})
    stack, opened = [root], Counter()

    def close_through(names: set[str] | frozenset[str], stop: set[str] | frozenset[str]) -> None:
        if not any(opened[n] for n in names):
            return
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].name in names:
                opened.subtract(e.name for e in stack[i:])
                del stack[i:]
                return
            if stack[i].name in stop:
                return

    def back_to(names: frozenset[str]) -> None:
        while stack[-1].name not in names and len(stack) > 1:
            opened[stack.pop().name] -= 1

    def add(node: Element | str) -> None:
        """Append to the open element; in a part of a table, what cannot stand there goes before the table."""
        if stack[-1].name in PARTS and opened["table"] and (node.strip() if isinstance(node, str) else node.name not in STAYS):
            table = next(i for i in range(len(stack) - 1, 0, -1) if stack[i].name == "table")
            stack[table - 1].children.insert(-1, node)  # an open table is the last child
        else:
            stack[-1].children.append(node)

    at = 0
    while m := _TAG.search(page, at):
        if m.start() > at:
            add(entities.unescape(page[at : m.start()]))
        at = m.end()
        if m[1] is not None:
            add(m[1])
            continue
        if m[3] is None:
            continue
        name = m[3].lower()
        if m[2]:
            if name == "p" and not opened["p"]:
                add(Element("p", {}))
            elif name == "br":
                add(Element("br", {}))
            elif name not in ("html", "body"):
                close_through({name}, {"td", "th", "table"} - {name} if name not in ("table", "tr", "tbody", "thead", "tfoot") else {"table"} - {name})
            continue
        if name == "html":
            root.attrs = {**_attrs(m[4]), **root.attrs}
            continue
        if name in IMPLIED:
            close_through(*IMPLIED[name])
        if name in CLOSES_P:
            close_through({"p"}, SCOPE | {"button"})
        if opened["table"]:
            if name in PART_IN:
                back_to(PART_IN[name])
                if name in ("td", "th") and stack[-1].name != "tr":
                    add(Element("tr", {}))
                    stack.append(stack[-1].children[-1])
                    opened["tr"] += 1
            elif name == "table" and stack[-1].name in PARTS:
                close_through({"table"}, frozenset())
        element = Element(name, _attrs(m[4]))
        if name == "form" and stack[-1].name in PARTS and opened["table"]:
            stack[-1].children.append(element)  # holds nothing
            continue
        add(element)
        foreign = [x for x in UNSHOWN if opened[x]]
        if any(name in UNSHOWN[x] for x in foreign):
            element.attrs["hidden"] = ""
        if (foreign or name in UNSHOWN) and m[4].endswith("/") and not _BARE_VALUE.search(m[4]):
            continue
        if name == "plaintext":  # nothing ends it
            element.children.append(page[at:])
            break
        if name in RAW:
            end = _RAW_END[name].search(page, at)
            stop = end.start() if end else len(page)
            inner = page[at:stop]
            element.children.append(entities.unescape(inner) if name in ("textarea", "title") else inner)
            close = page.find(">", stop)
            at = len(page) if not end or close < 0 else close + 1
        elif name not in VOID:
            stack.append(element)
            opened[name] += 1
    else:
        if at < len(page):
            add(entities.unescape(page[at:]))
    return root


def visible(e: Element) -> bool:
    if e.name in HIDDEN or "hidden" in e.attrs or (e.attrs.get("aria-hidden") == "true" and e.name == "i"):
        return False
    if e.name == "rp" or (e.name == "dialog" and "open" not in e.attrs):
        return False
    if e.name == "input":
        return e.attrs.get("type", "").lower() in ("submit", "button", "reset")
    return not ("style" in e.attrs and _UNSEEN.search(e.attrs["style"]))


def width(text: str) -> int:
    """Columns on a terminal."""
    if text.isascii():
        return len(text)
    return sum(0 if unicodedata.combining(c) else 2 if unicodedata.east_asian_width(c) in "WF" else 1 for c in text)


CELL_WIDTH = 80
"""Lines of a cell are broken at blanks beyond this width, and no column is padded further."""
MOST_ROOM = 2 * CELL_WIDTH
"""A cell over several columns, or a run of columns that cells from above reach into, is padded to no more, so a page's text stays a small multiple of it."""


def broken(text: str) -> str:
    """Lines of at most ``CELL_WIDTH`` columns, except for single words that are wider."""
    out = []
    for line in text.split("\n"):
        if width(line) <= CELL_WIDTH:
            out.append(line)
            continue
        lead = line[: len(line) - len(line.lstrip(" "))]
        made, used = [], 0
        for word in line.split(" "):
            wide = width(word)
            if used and used + 1 + wide > CELL_WIDTH:
                out.append(" ".join(made))
                made, used = [lead + word] if lead else [word], len(lead) + wide
            else:
                made.append(word)
                used += wide + (len(made) > 1)
        out.append(" ".join(made))
    return "\n".join(out)


class Writer:
    """Lines in the making: collapses blanks, and sets blocks apart by at most one empty line."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.parts: list[str] = []
        self.blank = False  # a blank waits for the next word
        self.gap = False  # an empty line waits for the next text
        self.indent: list[str] = []
        self.bullet = ""
        self.fixed = False  # some lines must stay as they are

    def text(self, text: str) -> None:
        words = _SPACE.split(text)
        for i, word in enumerate(words):
            if i and (self.parts or self.bullet):
                self.blank = bool(self.parts)
            if word:
                if self.blank:
                    self.parts.append(" ")
                self.parts.append(word)
                self.blank = False

    def literal(self, text: str) -> None:
        self.fixed = True
        for i, line in enumerate(text.replace("\r\n", "\n").split("\n")):
            if i:
                self.end(keep=True)
            if line:
                self.parts.append(line)

    def end(self, keep: bool = False) -> None:
        """End the line; without text, only ``keep`` leaves an empty one."""
        if self.parts or self.bullet or keep:
            if self.gap and self.lines:
                self.lines.append("")
            self.gap = False
            lead = "".join(self.indent)
            if self.bullet:
                lead = lead[: len(lead) - len(self.bullet)] + self.bullet
            self.lines.append((lead + "".join(self.parts)).rstrip())
        self.parts, self.blank, self.bullet = [], False, ""

    def space(self) -> None:
        self.end()
        self.gap = True

    def result(self) -> str:
        self.end()
        return "\n".join(self.lines)


def _sections(table: Element) -> list[list[list[Element]]]:
    """The rows of each section; rows straight in the table are sections too."""
    made: list[list[list[Element]]] = [[]]
    for e in table.children:
        if not isinstance(e, Element) or not visible(e):
            continue
        if e.name in ("tbody", "thead", "tfoot"):
            made += [[_cells(c) for c in e.children if isinstance(c, Element) and c.name == "tr" and visible(c)], []]
        elif e.name == "tr":
            made[-1].append(_cells(e))
    return made


def _cells(row: Element) -> list[Element]:
    return [c for c in row.children if isinstance(c, Element) and c.name in ("td", "th") and visible(c)]


def _rows(table: Element) -> list[list[Element]]:
    return [row for section in _sections(table) for row in section]


def _span(cell: Element, name: str = "colspan", most: int = 1000, zero: int = 1) -> int:
    value = cell.attrs.get(name, "")
    return min(int(value), most) or zero if value.isdecimal() and value.isascii() and len(value) < 9 else 1


def _grid(table: Element, done: dict[int, str]) -> list[list[tuple[str, int]]]:
    """Rows of (text, span) with an empty cell where cells from above reach down, one for neighbouring columns."""
    out = []
    for section in _sections(table):
        down: list[tuple[int, int, int]] = []  # column, span and last row of the cells that reach below their own, from left to right
        for i, cells in enumerate(section):
            row, column, more, at = [], 0, [], 0
            for cell in cells:
                while at < len(down) and down[at][0] <= column:
                    row.append(("", down[at][1]))
                    column = down[at][0] + down[at][1]
                    at += 1
                span, rows = _span(cell), _span(cell, "rowspan", 65_534, len(section))
                row.append((done.get(id(cell), ""), span))
                if rows > 1 and i + 1 < len(section):
                    more.append((column, span, min(i + rows, len(section)) - 1))
                column += span
            # To the right of a row's own cells only those that follow at once, so columns stay in place.
            while cells and at < len(down) and down[at][0] <= column:
                row.append(("", down[at][1]))
                column = down[at][0] + down[at][1]
                at += 1
            down = _joined(sorted(down + more), i + 1)
            out.append(row)
    return out


def _joined(down: list[tuple[int, int, int]], row: int) -> list[tuple[int, int, int]]:
    """The cells that reach ``row``; neighbours that end together count as one."""
    out: list[tuple[int, int, int]] = []
    for column, span, last in down:
        if last < row:
            continue
        if out and out[-1][2] == last and out[-1][0] + out[-1][1] == column:
            out[-1] = (out[-1][0], out[-1][1] + span, last)
        else:
            out.append((column, span, last))
    return out


def _align(rows: list[list[tuple[str, int]]]) -> list[str]:
    """Rows of (text, span) as lines; a cell of several lines fills several, and each column is as wide as its widest line, ``CELL_WIDTH`` at most."""
    widths: dict[int, int] = {}
    split = [[(text.split("\n"), span) for text, span in row] for row in rows]
    for row in split:
        column = 0
        for lines, span in row:
            if span == 1:
                widths[column] = max(widths.get(column, 0), min(CELL_WIDTH, max(map(width, lines))))
            column += span
    columns = sorted(widths)
    total = [0, *itertools.accumulate(widths[c] for c in columns)]
    out = []
    for row in split:
        rooms, column = [], 0
        for _, span in row:
            room = total[bisect_left(columns, column + span)] - total[bisect_left(columns, column)] + 3 * (span - 1)
            rooms.append(min(room, MOST_ROOM))
            column += span
        for i in range(max((len(lines) for lines, _ in row), default=0)):
            # What follows the last cell with text in this line would be blank.
            last = max((k for k, (lines, _) in enumerate(row) if i < len(lines) and lines[i]), default=-1)
            shown = [lines[i] if i < len(lines) else "" for lines, _ in row[: last + 1]]
            made = [line + " " * max(0, room - width(line)) for line, room in zip(shown, rooms)]
            out.append((" | ".join(made) + (" |" if last + 1 < len(row) else "")).rstrip())
    return out


def render(page: str | None) -> str:
    """All visible text of a page. Tables inside cells are rendered first, then placed as the cell's lines."""
    root = tree(page or "")
    done: dict[int, str] = {}  # rendered cells
    jobs: list[tuple[Element, bool]] = [(root, False)]
    while jobs:
        top, ready = jobs.pop()
        if not ready:
            jobs.append((top, True))
            waiting = [c for c in top.children if isinstance(c, Element)]
            while waiting:
                e = waiting.pop()
                if not visible(e):
                    continue
                if e.name == "table":
                    jobs += [(cell, False) for row in _rows(e) for cell in row]
                    waiting += [c for c in e.children if isinstance(c, Element) and c.name not in ("tr", "tbody", "thead", "tfoot")]
                else:
                    waiting += [c for c in e.children if isinstance(c, Element)]
        else:
            made, fixed = _render_one(top, done)
            done[id(top)] = made if fixed or top is root else broken(made)
    return done[id(root)]


def _render_one(top: Element, done: dict[int, str]) -> tuple[str, bool]:
    """The text of an element, and whether its lines must stay as they are."""
    out, pre = Writer(), 0
    lists: list[list] = []  # [ordered, next number]
    actions: list[tuple[str, object]] = [("node", c) for c in reversed(top.children)]
    while actions:
        kind, node = actions.pop()
        if kind == "node" and isinstance(node, str):
            out.literal(node) if pre else out.text(node)
        elif kind == "node":
            if not visible(node):
                continue
            name, after = node.name, []
            if name == "br":
                out.end(keep=True)
                continue
            if name in ("img", "area"):
                if node.attrs.get("alt"):
                    out.text(node.attrs["alt"])
                continue
            if name == "input":
                out.text(node.attrs.get("value", ""))
                continue
            if name == "hr":
                out.space()
                out.literal("---")
                out.space()
                continue
            if name in SPACED and not (name in ("ul", "ol") and lists):
                out.space()
                after.append(("space", None))
            elif name in BLOCK:
                out.end()
                after.append(("end", None))
            inside = node.children
            if name == "table":
                inside = [c for c in node.children if not isinstance(c, Element) or c.name not in ("tr", "tbody", "thead", "tfoot", "colgroup")]
                after.insert(0, ("rows", _align(_grid(node, done))))
            elif name in ("ul", "ol", "menu", "dir"):
                start = node.attrs.get("start", "")
                first = int(start) if re.fullmatch(r"-?[0-9]{1,9}", start or "") else 1
                lists.append([name == "ol", first])
                after.append(("list", None))
            elif name == "li":
                bullet = f"{lists[-1][1]}. " if lists and lists[-1][0] else "- "
                if lists:
                    lists[-1][1] += 1
                out.indent.append(" " * len(bullet))
                out.bullet = bullet
                after += [("outdent", None)]
            elif name in ("dd", "blockquote"):
                out.indent.append("    " if name == "dd" else "> ")
                after.append(("outdent", None))
            elif name in ("pre", "textarea", "xmp", "plaintext"):
                pre += 1
                after.append(("pre", None))
            elif name == "text":
                out.text(" ")
                after.append(("blank", None))
            elif name == "q":
                out.text('"')
                after.append(("quote", None))
            actions += after[::-1] if name not in ("li", "dd", "blockquote") else after[::-1]
            actions += [("node", c) for c in reversed(inside)]
        elif kind == "rows":
            out.end()
            for line in node:
                out.literal(line)
                out.end(keep=True)
        elif kind == "space":
            out.space()
        elif kind == "end":
            out.end()
        elif kind == "outdent":
            out.end()
            out.indent.pop()
        elif kind == "list":
            lists.pop()
        elif kind == "pre":
            pre -= 1
        elif kind == "blank":
            out.text(" ")
        elif kind == "quote":
            out.text('"')
    return out.result(), out.fixed


def _extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        texts = [render(page) for page in batch.html]
        rows = {"page_id": batch.page_id.to_numpy(), "text": texts, "n_lines": [t.count("\n") + 1 if t else 0 for t in texts]}
        yield pd.DataFrame(rows).astype({"page_id": "Int64"})


def extract(pages: DataFrame, page_id: str = "page_id", html: str = "html") -> DataFrame:
    """page_id, text, n_lines for each row, without a shuffle.

    A NULL or empty page, or one that shows nothing, has the empty text and no lines. Rows are rendered one by one, so repeated ones
    are alike; further columns are not read. Lines of table cells are broken beyond ``CELL_WIDTH`` columns, in all tables alike; padding is bounded,
    so time and text follow the page's length, whatever its spans.
    """
    rows = pages.select(F.col(f"`{page_id}`").cast("long").alias("page_id"), F.col(f"`{html}`").alias("html"))
    return rows.mapInPandas(_extract, "page_id long, text string, n_lines long")
