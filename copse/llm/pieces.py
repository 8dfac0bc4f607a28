"""Encoding texts to the ids of a SentencePiece vocabulary, and back.

A text's blanks become word marks, and it is cut before each run of marks, where no piece of the vocabulary can cross. Texts stay where the scan reads them:
each task folds the distinct words of about ``BLOCK_BYTES`` of texts together, and keeps a bounded store of words for the next ones, so nothing is shuffled.
Many words are folded at once as arrays of places by words. A trie of the pieces gives all edges of their lattices, and each lattice is folded into ids:

* ``viterbi``: the path of the largest sum of scores, end by end;
* ``merges``: the best-ranked edge over two neighbouring segments is taken until there is none, as vocabularies of merges are meant to be read.

Both folds are given for every text: the ids by merges are what the public vocabulary's own encoder gives.

Characters without a piece become their bytes.
"""

from __future__ import annotations

import heapq
import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK_BYTES = 2_000_000
"""Bytes of texts whose words are looked up together, about; a task holds one block and its distinct words."""

KNOWN_CHARS = 4_000_000
"""Characters of the words that a task keeps from one block to the next; beyond, its store is emptied."""

FOLDED_CHARS = 1 << 16
"""Characters of the words that are folded together, about; a group's table of edges takes 4 bytes for each, times the longest piece."""

LONG_WORD = 1_000
"""Lattices of longer words are folded one by one: merging many at once takes time by the square of their length."""

MAX_PIECES = 500_000
"""Larger vocabularies are refused; each task holds the pieces."""

MARK = "▁"
NO_CHAR = 0x110000


class Vocabulary:
    """The pieces of a model file, and their trie. Refuses models whose pieces cross from one word into the next."""

    def __init__(self, path: str | None = None):
        model = sentencepiece.SentencePieceProcessor(model_file=path or public_tokenizers.path("piece_bpe_32k.model"))
        size = model.get_piece_size()
        if size > MAX_PIECES:
            raise ValueError(f"more than {MAX_PIECES} pieces")
        self.rows, self.bytes, self.spelling = [], [0] * 256, []
        for i in range(size):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.bytes[int(piece[1:-1], 16)] = i
                self.spelling.append(bytes([int(piece[1:-1], 16)]))
            elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                self.spelling.append(b"")
            else:
                if re.search(f"[^{MARK}]{MARK}", piece):
                    raise ValueError(f"piece {i} goes over the end of a word")
                self.rows.append((piece, i, float(model.get_score(i))))
                self.spelling.append(piece.replace(MARK, " ").encode())
        self.longest = max(len(r[0]) for r in self.rows)
        self.scores = np.full(size + 1, min(r[2] for r in self.rows) - 10.0)
        """By id; the last one, also at -1, is that of a character without a piece."""
        for _, i, value in self.rows:
            self.scores[i] = value
        self._grow()

    def _grow(self) -> None:
        """The pieces' trie: characters to the nodes below the root, (node, character) to node in an open hash table, and the piece that ends at each node (or -1). Node 0 is none, node 1 the root."""
        node, ends = {"": 1}, {}
        for piece, i, _ in self.rows:
            for k in range(1, len(piece) + 1):
                node.setdefault(piece[:k], len(node) + 1)
            ends[node[piece]] = i
        self.ends = np.full(len(node) + 1, -1, dtype=np.int32)
        self.ends[list(ends)] = list(ends.values())
        self.bits = (4 * len(node)).bit_length()
        self.keys, self.next = np.zeros(1 << self.bits, dtype=np.int64), np.zeros(1 << self.bits, dtype=np.int32)
        self.first = np.zeros(NO_CHAR, dtype=np.int32)
        for prefix, i in node.items():
            if len(prefix) == 1:
                self.first[ord(prefix)] = i
        below = {node[p[:-1]] << 21 | ord(p[-1]): i for p, i in node.items() if len(p) > 1}
        full: set[int] = set()
        for at, (key, i) in zip(self._slot(np.array(list(below))).tolist(), below.items(), strict=True):
            while at in full:
                at = (at + 1) & (len(self.keys) - 1)
            full.add(at)
            self.keys[at], self.next[at] = key, i

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def _step(self, nodes: np.ndarray, chars: np.ndarray) -> np.ndarray:
        keys = nodes.astype(np.int64) << 21 | chars
        at = self._slot(keys)
        there = self.keys[at]
        same = there == keys
        out = np.where(same, self.next[at], 0)
        open_ = np.flatnonzero(~same & (there != 0))
        while len(open_):
            at[open_] = (at[open_] + 1) & (len(self.keys) - 1)
            there = self.keys[at[open_]]
            out[open_] = np.where(there == keys[open_], self.next[at[open_]], 0)
            open_ = open_[(there != keys[open_]) & (there != 0)]
        return out

    def lattice(self, chars: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """All edges over ``chars`` (places by words), by length: (length, start * words + word in ascending order, ids). ``NO_CHAR`` fills short words."""
        width, flat = chars.shape[1], chars.ravel()
        at = np.flatnonzero(flat != NO_CHAR)
        nodes = self.first[flat[at]]
        for length in range(1, self.longest + 1):
            found = self.ends[nodes]
            some = np.flatnonzero(found >= 0)
            yield length, at[some], found[some]
            on = np.flatnonzero((nodes > 0) & (at < len(flat) - length * width))
            at = at[on]
            nodes = self._step(nodes[on], flat[at + length * width])


def viterbi(lengths: np.ndarray, edges: list[tuple[np.ndarray, np.ndarray]], table: np.ndarray, scores: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The largest sum of scores for each word, and for each place of each word the end of the path's segment from there, or 0.

    A single character is always an edge, with the last of ``scores`` if it is no piece; of equal paths the one whose last segment is longer.
    """
    _, n, width = table.shape
    best, back = np.zeros((n + 1, width)), np.zeros((n + 1, width), dtype=np.int16)
    bounds = [np.searchsorted(at, np.arange(n + 1) * width) for at, _ in edges]
    for stop in range(1, n + 1):
        top, origin = np.full(width, -np.inf), back[stop]
        for length in range(min(stop, len(edges)), 1, -1):
            start, (at, ids) = stop - length, edges[length - 1]
            here = slice(bounds[length - 1][start], bounds[length - 1][start + 1])
            if here.start < here.stop:
                who = at[here] - start * width
                total = best[start, who] + scores[ids[here]]
                better = total > top[who]
                top[who[better]], origin[who[better]] = total[better], start
        total = best[stop - 1] + scores[table[0, stop - 1]]
        origin[total > top] = stop - 1
        best[stop] = np.maximum(top, total)
    ends, at, live = np.zeros((n, width), dtype=np.int16), lengths.copy(), np.arange(width)
    while len(live):
        start = back[at[live], live]
        ends[start, live] = at[live]
        at[live] = start
        live = live[start > 0]
    return best[lengths, np.arange(width)], ends


def merges(lengths: np.ndarray, table: np.ndarray, scores: np.ndarray) -> np.ndarray:
    """Segment ends, placed as by ``viterbi``: of the edges over two neighbouring segments the best score is taken, the leftmost of equals, until none is left."""
    longest, n, width = table.shape
    scores = np.append(scores[:-1], -np.inf)
    places = np.arange(n + 1, dtype=np.int16)[:, None]
    after, before = np.repeat(places + 1, width, axis=1), np.repeat(places - 1, width, axis=1)
    after[n] = n + longest + 1  # too far for any piece
    gone = np.zeros((n, width), dtype=bool)

    def over_two(start: np.ndarray, who: np.ndarray) -> np.ndarray:
        length = after[after[start, who], who] - start
        return np.where(length <= longest, scores[table[np.minimum(length, longest) - 1, start, who]], -np.inf)

    rank = np.full((width, n), -np.inf)
    rank[:, : n - 1] = scores[table[1, : n - 1]].T
    live = np.arange(width)
    while len(live):
        start = rank[live].argmax(axis=1)
        some = rank[live, start] > -np.inf
        live, start = live[some], start[some]
        middle = after[start, live]
        stop = after[middle, live]
        gone[middle, live] = True
        rank[live, middle] = -np.inf
        after[start, live], before[stop, live] = stop, start
        rank[live, start] = over_two(start, live)
        previous = before[start, live]
        left = previous >= 0
        rank[live[left], previous[left]] = over_two(previous[left], live[left])
    return np.where(gone | (places[:n] >= lengths), 0, after[:n])


def _merged(n: int, edges: list[tuple[int, int, float]]) -> list[int]:
    """What ``merges`` gives, in n log n steps: a heap of the edges over two neighbouring segments."""
    score = {(a, b): s for a, b, s in edges if b - a > 1}
    after, before = list(range(1, n + 2)), list(range(-1, n + 1))  # neighbouring ends of segments
    heap = [(-s, a, b) for (a, b), s in score.items() if b - a == 2]
    heapq.heapify(heap)
    gone = [False] * (n + 1)

    def push(a: int) -> None:
        if 0 <= a < n and after[a] < n and (s := score.get((a, after[after[a]]))) is not None:
            heapq.heappush(heap, (-s, a, after[after[a]]))

    while heap:
        _, a, b = heapq.heappop(heap)
        if gone[a] or after[a] >= n or after[after[a]] != b:
            continue
        gone[after[a]] = True
        after[a], before[b] = b, a
        push(a)
        push(before[a])
    ends = [0]
    while ends[-1] < n:
        ends.append(after[ends[-1]])
    return ends


def _best_path(n: int, edges: list[tuple[int, int, float]], unknown: float) -> tuple[float, list[int]]:
    """What ``viterbi`` gives, in one pass over the edges."""
    by_stop: dict[int, list] = {}
    for a, b, s in edges:
        by_stop.setdefault(b, []).append((a, s))
    best = [(0.0, 0)]
    for stop in range(1, n + 1):
        ways = [(best[a][0] + s, -a) for a, s in by_stop.get(stop, [])]
        if not any(a == stop - 1 for a, _ in by_stop.get(stop, [])):
            ways.append((best[stop - 1][0] + unknown, 1 - stop))
        score, back = max(ways)
        best.append((score, -back))
    ends = [n]
    while ends[-1]:
        ends.append(best[ends[-1]][1])
    return best[n][0], ends[::-1]


def _utf8(chars: np.ndarray) -> bytes:
    return chars.astype("<u4").tobytes().decode("utf-32-le").encode()


def _words(texts: pa.Array) -> pa.Array:
    """The words of each text: a mark is put before it and for each of its blanks, and each run of marks begins a word."""
    large = pa.large_string()
    marked = pc.replace_substring(pc.binary_join_element_wise(pa.scalar(MARK, large), texts.cast(large), pa.scalar("", large)), " ", MARK)
    # There are no blanks now, so they can part the words: first one before each mark, then none between marks. What is left between the pairs goes the second time.
    apart = pc.replace_substring(marked, MARK, f" {MARK}")
    for _ in range(2):
        apart = pc.replace_substring(apart, f"{MARK} {MARK}", MARK + MARK)
    return pc.split_pattern(pc.utf8_slice_codeunits(apart, 1), " ")


class Words:
    """Ids by ``merges`` and by ``viterbi`` and the latter's score, of words, which are numbered as they come."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary, self.byte_ids = vocabulary, np.array(vocabulary.bytes, dtype=np.int32)
        self.clear()

    def clear(self) -> None:
        self.number: defaultdict[str, int] = defaultdict()
        self.number.default_factory = self.number.__len__
        self.chars = 0
        self.scores = np.zeros(0)
        self.ids = [np.zeros(0, dtype=np.int32)] * 2
        self.starts = [np.zeros(0, dtype=np.int64)] * 2
        self.counts = [np.zeros(0, dtype=np.int64)] * 2

    def numbers(self, words: pa.Array) -> np.ndarray:
        """Of distinct words; new ones are folded and get the next numbers."""
        if self.chars > KNOWN_CHARS:
            self.clear()
        known = len(self.number)
        plain = words.to_numpy(zero_copy_only=False)
        numbers = np.fromiter(map(self.number.__getitem__, plain.tolist()), dtype=np.int64, count=len(words))
        new = np.flatnonzero(numbers >= known)
        if len(new):
            lengths = pc.utf8_length(words).to_numpy()[new].astype(np.int64)
            self._add(plain[new], lengths)
        return numbers

    def _add(self, words: np.ndarray, lengths: np.ndarray) -> None:
        order = np.argsort(lengths, kind="stable")
        words, lengths = words[order].tolist(), lengths[order]
        done, at, short = [], 0, int(np.searchsorted(lengths, LONG_WORD, side="right"))
        while at < short:
            chars = lengths[at:short] * np.arange(1, short - at + 1)
            stop = at + max(1, int(np.searchsorted(chars, FOLDED_CHARS, side="right")))
            done.append(self._fold(words[at:stop], lengths[at:stop]))
            at = stop
        done += [self._fold_long(word) for word in words[short:]]
        self.chars += int(lengths.sum())
        place = np.argsort(order)
        self.scores = np.concatenate([self.scores, np.concatenate([d[0] for d in done])[place]])
        for k in (0, 1):
            counts = np.concatenate([d[1][k][1] for d in done])
            starts = len(self.ids[k]) + np.cumsum(counts) - counts
            self.ids[k] = np.concatenate([self.ids[k], *(d[1][k][0] for d in done)])
            self.starts[k] = np.concatenate([self.starts[k], starts[place]])
            self.counts[k] = np.concatenate([self.counts[k], counts[place]])

    def _fold(self, words: list[str], lengths: np.ndarray) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
        """Of words of ascending length: scores, and twice (ids, how many for each word), by ``merges`` and by ``viterbi``."""
        vocabulary, n = self.vocabulary, int(lengths[-1])
        by_word = np.full((len(words), n), NO_CHAR, dtype=np.int64)
        by_word[np.arange(n) < lengths[:, None]] = np.frombuffer("".join(words).encode("utf-32-le"), dtype="<u4")
        chars = np.ascontiguousarray(by_word.T)
        table, edges = np.full((max(2, vocabulary.longest), n, len(words)), -1, dtype=np.int32), []
        for length, at, ids in vocabulary.lattice(chars):
            table[length - 1].ravel()[at] = ids
            edges.append((at, ids))
        score, path = viterbi(lengths, edges, table, vocabulary.scores)
        both = []
        for ends in (merges(lengths, table, vocabulary.scores), path):
            who, start = np.nonzero(ends.T)
            ids = table[ends[start, who] - start - 1, start, who]
            none = ids < 0
            code = chars[start[none], who[none]]
            counts = np.ones(len(ids), dtype=np.int64)
            counts[none] += (code > 0x7F) + (code > 0x7FF).astype(np.int64) + (code > 0xFFFF)
            out = np.repeat(ids, counts)
            out[np.repeat(none, counts)] = self.byte_ids[np.frombuffer(_utf8(code), dtype=np.uint8)]
            both.append((out, np.bincount(who, weights=counts, minlength=len(words)).astype(np.int64)))
        return score, both

    def _fold_long(self, word: str) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
        """What ``_fold`` gives for one word, by a heap and one pass over its edges."""
        scores, known = self.vocabulary.scores, {}
        for length, at, ids in self.vocabulary.lattice(np.frombuffer(word.encode("utf-32-le"), dtype="<u4").astype(np.int64)[:, None]):
            known.update(((a, a + length), i) for a, i in zip(at.tolist(), ids.tolist(), strict=True))
        edges = [(*span, float(scores[i])) for span, i in known.items()]
        score, path = _best_path(len(word), edges, float(scores[-1]))
        both = []
        for cuts in (_merged(len(word), edges), path):
            out: list[int] = []
            for a, b in zip(cuts, cuts[1:]):
                found = known.get((a, b))
                out += [found] if found is not None else [int(self.byte_ids[x]) for x in word[a:b].encode()]
            both.append((np.array(out, dtype=np.int32), np.array([len(out)])))
        return np.array([score]), both

    def of_texts(self, texts: pa.Array) -> tuple[pa.Array, pa.Array, pa.Array]:
        """ids, best_ids, best_score of each text; a NULL has no words."""
        split = _words(texts)
        stops = np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(split), 0).to_numpy())])
        coded = split.flatten().dictionary_encode()
        numbers = self.numbers(coded.dictionary)[coded.indices.to_numpy()]
        both = []
        for ids, starts, all_counts in zip(self.ids, self.starts, self.counts, strict=True):
            counts = all_counts[numbers]
            total = np.concatenate([[0], np.cumsum(counts)])
            at = np.repeat((starts[numbers] - total[:-1]).astype(np.int32), counts)
            at += np.arange(total[-1], dtype=np.int32)
            both.append(pa.ListArray.from_arrays(pa.array(total[stops], type=pa.int32()), pa.array(ids[at])))
        row = np.repeat(np.arange(len(texts)), np.diff(stops))
        score = np.bincount(row, weights=self.scores[numbers], minlength=len(texts)).astype(float)
        return *both, pa.array(score)


def _encoder(vocabulary: Vocabulary, block_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words(vocabulary)
        for batch in batches:
            sizes = np.cumsum(batch.column("size").to_numpy())
            at = 0
            while at < len(sizes):
                stop = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + block_bytes, side="right")))
                part = batch.slice(at, stop - at)
                columns = [part.column("doc_id"), *words.of_texts(part.column("text"))]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "ids", "best_ids", "best_score"])
                at = stop

    return run


def encode(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """doc_id, ids, best_ids (arrays of int), best_score for each row, by whole texts: the ids by merges, and the path of the largest sum of scores.

    A NULL or empty text has no ids and score 0. Repeated rows are encoded alike; further columns are not read; an empty table gives an empty result.
    A blank is put before the text, as the model's training did. Rows are neither moved nor put in order; a task folds a word once for each time its store is emptied.
    """
    text_ = F.nullif(F.col(f"`{text}`"), F.lit(""))
    size = F.coalesce(F.octet_length(text_), F.lit(0)).cast("long") + 100
    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), text_.alias("text"), size.alias("size"))
    schema = "doc_id long, ids array<int>, best_ids array<int>, best_score double"
    return rows.mapInArrow(_encoder(Vocabulary(path), BLOCK_BYTES), schema)


def _spelled(ids: Column, spelling: list[bytes]) -> Column:
    """The text of an array of ids: their bytes as hexadecimal digits, joined, without a blank in front."""
    table = F.split(F.lit(",".join(b.hex() for b in spelling)), ",")
    joined = F.array_join(F.transform(F.coalesce(ids, F.array().cast("array<int>")), lambda i: F.element_at(table, i + 1)), "")
    text = F.unhex(F.when(joined.startswith(b" ".hex()), F.substring(joined, 3, 2**31 - 1)).otherwise(joined))
    return F.make_valid_utf8(text.cast("string"))


def with_decoded(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """Rows (doc_id, ids, ...) with ``decoded``, the text that ``decode`` gives, beside the ids it comes from; without a shuffle."""
    return encoded.withColumn("decoded", _spelled(F.col("ids"), Vocabulary(path).spelling))


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, text of rows (doc_id, ids): pieces and bytes in order, without the blank put in front. NULL ids are an empty text; bytes that are no UTF-8 become U+FFFD."""
    return with_decoded(encoded.select("doc_id", "ids"), path).select("doc_id", F.col("decoded").alias("text"))
