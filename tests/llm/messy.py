"""A small table with everything that a text column may hold, and the plain rules that results are held against."""

from __future__ import annotations

import re

WORDS = "the quick brown fox jumps over a lazy dog while seven wizards box up quirky jars of zinc and plum jam near old mill".split()
LONG = " ".join(WORDS[i * 7 % len(WORDS)] + str(i % 97) for i in range(30_000))
LINES = "\n".join(" ".join(WORDS[(i + j) % len(WORDS)] for j in range(12)) + f" {i}" for i in range(9))

TEXTS = [
    None, "", " ", "\n\n \t", "...", "42 !! 17", "one", "two words", "Ünï çödé ñandú größe", "日本語のテキスト", "a b c", "x" * 5_000,
    "# * $ % & | < >", LINES, LINES, LINES.upper(), LINES.replace("quick", "slow"), LINES + "\nand one more line at the end of it", LINES + " tail",
    "same line here\n" * 30, LONG, LONG.replace("fox3", "cat3"), "tab\tand\vvertical\ffeed\r\nreturn", "the quick brown fox", "the quick brown fox jumps", "THE quick brown fox jumps",
    "Released under the MIT License.", "Licensed under the Apache License, Version 2.0, or under the MIT license", "SPDX-License-Identifier: MIT OR (Apache-2.0 AND BSD-3-Clause)",
    "<|endoftext|> and <|endoftext|>", "﻿bom and emoji 😀😀 \U0001f9d1‍\U0001f680", "<p>not a page</p>", "0" * 3, "WARC/1.1\r\nWARC-Type: response\r\n\r\n",
]


def rows() -> list[tuple]:
    out = [(i, t, ("en", "de", None)[i % 3], ("a", None)[i % 2], None if t is None else len(t), "clash", -1.5) for i, t in enumerate(TEXTS)]
    return [*out, out[13], out[13], (None, LINES, "en", "a", 1, "clash", 0.0), (None, None, None, None, None, None, None)]


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string, n_words double"


def frame(spark, partitions: int = 3):
    """The table with columns whose names results use too."""
    return spark.createDataFrame(rows(), SCHEMA).repartition(partitions)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def lower(text: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def words(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def counted(df, columns: list[str] | None = None) -> dict:
    """Rows as a multiset."""
    out: dict = {}
    for r in (df.select(*columns) if columns else df).collect():
        key = tuple(tuple(v) if isinstance(v, list) else v for v in r)
        out[key] = out.get(key, 0) + 1
    return out
