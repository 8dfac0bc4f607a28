"""Licence tags, notices and expressions in texts.

One Aho-Corasick automaton, built once for a task, finds notice phrases in the text's words and identifier tags in its
lower-cased characters. What follows a tag is read as a licence expression by a shunting-yard parser with ``and``, ``or``
and ``with``, and evaluated to nested choices (``|``) and sets to be met together (``&``), however many these are.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The base phrases and their labels.
BASE = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

# Further notice phrases and their labels.
NOTICES = {
    "permission is hereby granted free of charge": "mit",
    "licensed under the apache license": "apache-2",
    "gnu general public license version 2": "gpl-2",
    "gnu general public license version 3": "gpl-3",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "gnu free documentation license": "gfdl",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "european union public licence": "eupl",
    "common development and distribution license": "cddl",
    "boost software license": "bsl",
    "artistic license": "artistic",
    "zlib license": "zlib",
    "isc license": "isc",
    "bsd license": "bsd",
    "redistribution and use in source and binary forms": "bsd",
    "do what the fuck you want to public license": "wtfpl",
    "this is free and unencumbered software released into the public domain": "unlicense",
    "sil open font license": "ofl",
    "open database license": "odbl",
    "cc0 1 0 universal": "cc0",
    "creative commons attribution": "cc-by",
    "cc by sa": "cc-by-sa",
    "cc by nd": "cc-by-nd",
    "cc by nc sa": "cc-by-nc-sa",
    "cc by nc nd": "cc-by-nc-nd",
    "all rights reserved": "all-rights-reserved",
}

# Identifiers that mean a label above.
IDENTIFIERS = {
    "mit": "mit",
    "mit-0": "mit",
    "apache-2.0": "apache-2",
    "gpl-2.0": "gpl-2",
    "gpl-2.0+": "gpl-2",
    "gpl-2.0-only": "gpl-2",
    "gpl-2.0-or-later": "gpl-2",
    "gpl-3.0": "gpl-3",
    "gpl-3.0+": "gpl-3",
    "gpl-3.0-only": "gpl-3",
    "gpl-3.0-or-later": "gpl-3",
    "lgpl-2.1": "lgpl",
    "lgpl-2.1-only": "lgpl",
    "lgpl-2.1-or-later": "lgpl",
    "lgpl-3.0": "lgpl",
    "lgpl-3.0-only": "lgpl",
    "lgpl-3.0-or-later": "lgpl",
    "agpl-3.0": "agpl",
    "agpl-3.0-only": "agpl",
    "agpl-3.0-or-later": "agpl",
    "gfdl-1.3-only": "gfdl",
    "gfdl-1.3-or-later": "gfdl",
    "mpl-1.1": "mpl",
    "mpl-2.0": "mpl",
    "epl-1.0": "epl",
    "epl-2.0": "epl",
    "eupl-1.2": "eupl",
    "cddl-1.0": "cddl",
    "bsl-1.0": "bsl",
    "artistic-2.0": "artistic",
    "0bsd": "bsd",
    "bsd-2-clause": "bsd",
    "bsd-3-clause": "bsd",
    "ofl-1.1": "ofl",
    "odbl-1.0": "odbl",
    "cc0-1.0": "cc0",
    "cc-by-3.0": "cc-by",
    "cc-by-4.0": "cc-by",
    "cc-by-sa-3.0": "cc-by-sa",
    "cc-by-sa-4.0": "cc-by-sa",
    "cc-by-nd-4.0": "cc-by-nd",
    "cc-by-nc-4.0": "cc-by-nc",
    "cc-by-nc-sa-4.0": "cc-by-nc-sa",
    "cc-by-nc-nd-4.0": "cc-by-nc-nd",
}

TAG = "spdx-license-identifier:"
PRECEDENCE = {"or": 1, "and": 2, "with": 3}
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_TOKEN = re.compile(r"[()]|[a-z0-9][a-z0-9.+:-]*")

SCHEMA = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
    "score double, expressions array<string>"
)


def parse(text: str, start: int = 0, stop: int | None = None) -> list[str] | None:
    """The expression (lower case) that begins at ``start``, in postfix order, or None where there is none.

    Two operands without an operator between them end it, and nothing behind its end is read.
    """
    out: list[str] = []
    waiting: list[str] = []
    operand = False
    for found in _TOKEN.finditer(text, start, len(text) if stop is None else stop):
        token = found[0]
        if token == "(":
            if operand:
                break
            waiting.append(token)
        elif token == ")":
            if not operand or "(" not in waiting:
                break
            while waiting[-1] != "(":
                out.append(waiting.pop())
            waiting.pop()
        elif token in PRECEDENCE:
            if not operand:
                return None
            while waiting and waiting[-1] != "(" and PRECEDENCE[waiting[-1]] >= PRECEDENCE[token]:
                out.append(waiting.pop())
            waiting.append(token)
            operand = False
        else:
            if operand:
                break
            out.append(token)
            operand = True
    if not operand or "(" in waiting:
        return None
    return out + waiting[::-1]


def evaluate(postfix: list[str]) -> tuple[str, set[str]]:
    """An expression as nested text, and the licences in it.

    ``a | b`` is a choice, ``a & b`` asks for both, repeats left out; names that have to be met together are sorted. An exception
    joined by ``with`` stays at its licence and is none itself. Time and room follow the expression's length.
    """
    # Each entry: operator ("" for a name), its parts as an ordered set of names and of numbers of earlier nodes, and its licences.
    stack: list[tuple[str, dict, set[str]]] = []
    nodes: list[tuple[str, list]] = []

    def part(entry: tuple[str, dict, set[str]]) -> object:
        if not entry[0] or len(entry[1]) == 1:
            return next(iter(entry[1]))
        nodes.append((entry[0], list(entry[1])))
        return len(nodes) - 1

    for token in postfix:
        if token not in PRECEDENCE:
            stack.append(("", {token: None}, {token}))
            continue
        right, left = stack.pop(), stack.pop()
        if token == "with":
            stack.append(("with", {part(left): None, ("", part(right)): None}, left[2]))
            continue
        own = left if left[0] == token else right if right[0] == token and left[0] != token else None
        if own is left:
            left[1].update(right[1] if right[0] == token else {part(right): None})
            parts = left[1]
        elif own is right:
            parts = {part(left): None, **right[1]}
        else:
            parts = {part(left): None, part(right): None}
        names = left[2] if len(left[2]) >= len(right[2]) else right[2]
        names |= right[2] if names is left[2] else left[2]
        stack.append((token, parts, names))
    top = part(stack[0])
    return _written(top, nodes), stack[0][2]


_SIGNS = {"or": " | ", "and": " & ", "with": " with "}


def _written(top: object, nodes: list[tuple[str, list]]) -> str:
    out: list[str] = []
    actions: list[tuple[object, str]] = [(top, "")]
    while actions:
        node, outer = actions.pop()
        if isinstance(node, tuple):  # what follows a ``with``
            node = node[1]
        if node is None:
            out.append(outer)
        elif isinstance(node, str):
            out.append(node)
        else:
            sign, parts = nodes[node]
            if sign == "and":
                parts = sorted((p for p in parts if isinstance(p, str))) + [p for p in parts if not isinstance(p, str)]
            if outer and not (outer == "or" and sign in ("and", "with")) and not (outer == "and" and sign == "with"):
                out.append("(")
                actions.append((None, ")"))
            for i, p in enumerate(reversed(parts)):
                actions.append((p, sign))
                if i + 1 < len(parts):
                    actions.append((None, _SIGNS[sign]))
    return "".join(out)


def _label(name: str) -> str:
    return IDENTIFIERS.get(name, name)


class Scanner:
    """The automaton; both kinds of pattern are found in one pass over the words, tags in one over the characters."""

    def __init__(self) -> None:
        self.notices = ahocorasick.Automaton()
        for phrase, label in {**NOTICES, **BASE}.items():
            self.notices.add_word(f" {phrase} ", (phrase in BASE, label, len(phrase) + 2))
        self.notices.make_automaton()
        self.tags = ahocorasick.Automaton()
        self.tags.add_word(TAG, len(TAG))
        self.tags.make_automaton()

    def scan(self, text: str | None) -> tuple:
        lower = (text or "").encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")  # A-Z only
        words = _WORD.findall(lower)
        line = f" {' '.join(words)} "
        places, base, more = [], set(), set()
        at, words_before = 0, 0
        for end, (is_base, label, length) in self.notices.iter(line):
            more.add(label)
            if is_base:
                base.add(label)
                start = end - length + 1
                words_before += line.count(" ", at, start) if start >= at else -line.count(" ", start, at)
                at = start
                places.append(words_before)
        sure, expressions, stop = bool(base), [], -1
        for end, _ in self.tags.iter(lower):
            if stop <= end:
                stop = lower.find("\n", end + 1)
                stop = len(lower) if stop < 0 else stop
            postfix = parse(lower, end + 1, stop)
            if postfix:
                written, names = evaluate(postfix)
                expressions.append(written)
                more |= {_label(x) for x in names}
                sure = True
        score = 1.0 if sure else 0.5 if more else 0.0
        first, last = (min(places), max(places)) if places else (None, None)
        return len(words), len(places), first, last, ",".join(sorted(base)), ",".join(sorted(more)), score, expressions


def _scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    scanner = Scanner()
    columns = [c.split()[0] for c in SCHEMA.replace(", expressions", ",expressions").split(",")]
    for batch in batches:
        found = [scanner.scan(t) for t in batch.text]
        out = pd.DataFrame(found, columns=columns[1:])
        out.insert(0, "doc_id", batch.doc_id.to_numpy())
        yield out.astype({"doc_id": "Int64", "first_word": "Int64", "last_word": "Int64"})


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Licences of each row, by whole texts and without a shuffle.

    ``n_words``; ``n_base`` places of base phrases, the word at which the first and last begin (NULL without any); labels of
    base phrases, and all labels with those of notices and expressions; ``score`` 1 with a base phrase or a readable expression, 0.5
    with other notices alone, else 0; the evaluated expressions. A NULL text counts as empty: no words, no labels, score 0. Rows are
    judged one by one, so repeated ones are answered alike; further columns are not read.
    """
    return docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text")).mapInPandas(_scan, SCHEMA)
