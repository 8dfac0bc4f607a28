"""Token sequences of a fixed window, filled by best fit, longest pieces first.

Documents are tokenized as a whole. What exceeds a window is cut into full windows first; the remainders are dealt out by a
hash to groups of bounded size, and each group is packed in one task: pieces by decreasing length, each into the open window with
the least room that still holds it. A segment tree over the possible amounts of room finds that window.
"""

from __future__ import annotations

import base64
import sys
from array import array
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import public_tokenizers
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from copse.session import cut

WINDOW = 2_048
GROUP_PIECES = 20_000
"""Remainders in one group, about. A group leaves a few windows with room, so larger groups pad less."""

END_ID = 1
SPECIAL, SPECIAL_ID = "<|endoftext|>", 50_256
CACHED_WORDS = 200_000
CACHED_CHARS = 64
"""Longer words are not kept, so the store of known words is bounded in bytes too."""


def _as_bytes(ids: list[int]) -> bytes:
    """As little-endian unsigned 32-bit numbers."""
    numbers = array("I", ids)
    if sys.byteorder == "big":
        numbers.byteswap()
    return numbers.tobytes()


class Tokenizer:
    """Byte-level BPE ids of whole texts, equal to those of the ``byte_bpe_50k.json`` vocabulary without added special tokens.

    Texts are split by the vocabulary's own pattern, and the ids of a split are kept for its next occurrence, which makes repeated
    words cheap; the store is emptied when it is full, so memory is bounded.
    """

    def __init__(self, path: str | None = None):
        with open(path or public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as file:
            ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in file)}
        self.encoding = tiktoken.Encoding("bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.split = regex.compile(public_tokenizers.PATTERN).findall
        self.known: dict[str, bytes] = {}

    def _plain(self, text: str) -> list[bytes]:
        known, parts = self.known, []
        for word in self.split(text):
            ids = known.get(word)
            if ids is None:
                ids = _as_bytes(self.encoding.encode_ordinary(word))
                if len(word) <= CACHED_CHARS:
                    if len(known) >= CACHED_WORDS:
                        known.clear()
                    known[word] = ids
            parts.append(ids)
        return parts

    def encode(self, text: str | None) -> bytes:
        """Ids as little-endian unsigned 32-bit numbers, with the end id; the special token's own spelling is one id."""
        parts: list[bytes] = []
        for i, plain in enumerate((text or "").split(SPECIAL)):
            if i:
                parts.append(np.array([SPECIAL_ID], dtype="<u4").tobytes())
            parts += self._plain(plain)
        parts.append(np.array([END_ID], dtype="<u4").tobytes())
        return b"".join(parts)


def pieces_pass(window: int, path: str | None):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tokenizer = Tokenizer(path)
        for batch in batches:
            rows = []
            for key, text in zip(batch.doc_id, batch.text, strict=True):
                ids = tokenizer.encode(text)
                n = len(ids) // 4
                rows += [(key, at, min(window, n - at), n, ids[4 * at : 4 * min(at + window, n)]) for at in range(0, n, window)]
            yield pd.DataFrame(rows, columns=["doc_id", "start", "length", "doc_tokens", "ids"]).astype({"doc_id": "Int64"})

    return run


def pieces(docs: DataFrame, window: int = WINDOW, doc_id: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """doc_id, start, length, doc_tokens, ids of each piece: full windows, then the rest. A NULL text is an empty one: the end id alone."""
    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    return rows.mapInPandas(pieces_pass(window, path), "doc_id long, start long, length long, doc_tokens long, ids binary")


class RoomTree:
    """A segment tree over 0..window: for each amount of room the open windows that have it; finds the least amount that suffices."""

    def __init__(self, window: int):
        self.leaves = 1 << window.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.open: list[list[int]] = [[] for _ in range(window + 1)]

    def add(self, room: int, sequence: int) -> None:
        self.open[room].append(sequence)
        self._change(room, 1)

    def _change(self, room: int, by: int) -> None:
        at = room + self.leaves
        while at:
            self.count[at] += by
            at //= 2

    def take(self, need: int) -> tuple[int, int] | None:
        """Remove and return (room, sequence) of a window with the least room of at least ``need``."""
        at, count = need + self.leaves, self.count
        if not count[at]:
            # Up to the first ancestor with something to the right, then down to its leftmost leaf.
            while at > 1 and (at % 2 or not count[at + 1]):
                at //= 2
            if at <= 1:
                return None
            at += 1
            while at < self.leaves:
                at = 2 * at if count[2 * at] else 2 * at + 1
        room = at - self.leaves
        self._change(room, -1)
        return room, self.open[room].pop()


def best_fit_decreasing(lengths: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset of each piece. Pieces of equal length are taken in the given order."""
    tree, sequences = RoomTree(window), 0
    sequence, offset = np.zeros(len(lengths), dtype=np.int64), np.zeros(len(lengths), dtype=np.int64)
    for i in np.argsort(-lengths, kind="stable").tolist():
        need = int(lengths[i])
        found = tree.take(need)
        if found is None:
            found, sequences = (window, sequences), sequences + 1
        room, number = found
        sequence[i], offset[i] = number, window - room
        if room > need:
            tree.add(room - need, number)
    return sequence, offset


def pack_group(window: int):
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "doc_id", "start", "ids_crc32"], ascending=[False, True, True, True], kind="stable")
        number, offset = best_fit_decreasing(rows.length.to_numpy(), window)
        return rows.assign(sequence_id=(np.int64(key[0]) << np.int64(32)) | number, offset=offset)

    return run


def pack(docs: DataFrame, window: int = WINDOW, doc_id: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """Every piece of every row of ``docs`` with its place: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Sequences have at most ``window`` tokens and no gaps. A full window is a sequence of its own; the others are packed by groups of about
    ``GROUP_PIECES`` (a hash of document and place decides, so repeats of one document are spread by their place only). Each row counts, repeated
    ones too, and one with NULL id or text as well: an empty text is the end id alone. An empty table has no pieces. Further columns are not read.
    """
    found = pieces(docs, window, doc_id, text, path)
    found = cut(found.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", F.monotonically_increasing_id().alias("row")), "pieces")
    rest = found.filter(F.col("length") < window)
    groups = max(1, -(-rest.count() // GROUP_PIECES))
    group = F.pmod(F.xxhash64("row"), F.lit(groups))
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, group long, sequence_id long, offset long"
    columns = ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
    packed = rest.withColumn("group", group).drop("row").groupBy("group").applyInPandas(pack_group(window), schema)
    # Numbers of full windows are below zero, so they never meet those of the groups.
    full = found.filter(F.col("length") == window).withColumns({"sequence_id": -1 - F.col("row"), "offset": F.lit(0).cast("long")})
    return packed.select(*columns).unionByName(full.select(*columns))


def sequences(packed: DataFrame, docs: DataFrame, window: int = WINDOW, pad_id: int = 0) -> DataFrame:
    """The token ids of each sequence: sequence_id, ids (array, padded to the window unless their number is a power of two).

    Texts are tokenized once more and joined to their places; doc_id must be unique here.
    """
    placed = packed.select("doc_id", "start", "sequence_id", "offset").join(pieces(docs, window), ["doc_id", "start"])

    def join(batch: pd.DataFrame) -> pd.DataFrame:
        ids = np.frombuffer(reduce(bytes.__add__, batch.sort_values("offset").ids), dtype="<u4").astype(np.int64)
        if len(ids) & (len(ids) - 1):
            ids = np.pad(ids, (0, window - len(ids)), constant_values=pad_id)
        return pd.DataFrame({"sequence_id": [batch.sequence_id.iloc[0]], "ids": [ids]})

    return placed.groupBy("sequence_id").applyInPandas(join, "sequence_id long, ids array<long>")
