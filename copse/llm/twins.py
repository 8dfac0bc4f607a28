"""SQL twins of the text operators that SQL can express, run on the same tables by another engine."""

from __future__ import annotations

from copse.llm import negatives, quality

ARCHIVE = """
WITH p AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
h AS (SELECT page_id, payload, sha1(payload) AS hex FROM p),
d AS (
  SELECT page_id, payload, (
    SELECT string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
      1 + CAST((CAST('0x' || substr(hex, CAST(1 + 5 * (i // 4) AS BIGINT), 5) AS BIGINT) >> CAST(15 - 5 * (i % 4) AS INTEGER)) & 31 AS BIGINT), 1), '' ORDER BY i)
    FROM range(32) t(i)) AS payload_digest
  FROM h)
SELECT page_id, CAST(strlen(payload) AS BIGINT) AS payload_bytes, payload_digest,
  CASE WHEN page_id = best THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = best THEN NULL ELSE best END AS refers_to
FROM (SELECT *, max(page_id) OVER (PARTITION BY payload) AS best FROM d)
"""

JACCARD = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_transform(
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'),
    lambda x: translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS words
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
    ELSE list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' ')) END) AS shingle
  FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
  JOIN n x ON x.doc_id = a.doc_id JOIN n y ON y.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, x.n, y.n HAVING 100 * count(*) >= 75 * (x.n + y.n - count(*))),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents
  UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON l.a = r.other)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, r.component_id
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id
JOIN (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY 1) r ON r.doc_id = d.doc_id
"""


_MEASURES = ("symbols", "dup_lines", "repeats", "word_length")


def _fences() -> str:
    """A SELECT of the quantiles of one measure for each group, from its documents one by one."""
    reached = lambda tenths: f"min(value) FILTER (10 * place >= {tenths} * n)"
    return " UNION ALL ".join(
        f"""SELECT lang, {source} AS source, {whole} AS whole, '{measure}' AS measure, any_value(n) AS n,
        {reached(quality.TAIL_TENTHS)} AS low, {reached(5)} AS mid, {reached(10 - quality.TAIL_TENTHS)} AS high
        FROM (SELECT lang, source, {_leading(measure)} AS value, count(*) OVER (PARTITION BY {group}) AS n,
          row_number() OVER (PARTITION BY {group} ORDER BY {_leading(measure)}) AS place FROM m WHERE NOT base_failed) GROUP BY {group}"""
        for source, whole, group in (("source", "false", "lang, source"), ("NULL", "true", "lang"))
        for measure in _MEASURES
    )


def _leading(value: str) -> str:
    """A value's ten leading bits."""
    rest = f"CAST(greatest(length(bin({value})) - {quality.SKETCH_BITS}, 0) AS INTEGER)"
    return f"((({value}) >> {rest}) << {rest})"


def _share(count: str, of: str) -> str:
    return f"coalesce(CAST(floor(1000 * greatest({count} - 2 * sqrt(CAST({count} AS DOUBLE)), 0::DOUBLE) / nullif(CAST({of} AS DOUBLE), 0)) AS BIGINT), 0)"


QUALITY = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, lang, source, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words FROM d),
g AS (
  SELECT rid, i, count(*) OVER (PARTITION BY rid, gram) AS c FROM (
    SELECT rid, unnest(range(1, len(words) - 1)) AS i,
      unnest(list_transform(range(1, len(words) - 1), lambda i: words[i] || ' ' || words[i + 1] || ' ' || words[i + 2])) AS gram
    FROM w WHERE len(words) > 2)),
r AS (SELECT rid, count(DISTINCT i + k) AS n_repeat_words FROM g, range(3) t(k) WHERE c > 1 GROUP BY rid),
l AS (
  SELECT rid, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM (SELECT rid, unnest(string_split(t, chr(10))) AS line FROM d) WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY rid),
c AS (
  SELECT w.rid, doc_id, lang, source, CAST(len(words) AS BIGINT) AS n_words, CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
    CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(n_lines, 0) AS n_lines
  FROM w LEFT JOIN r ON r.rid = w.rid LEFT JOIN l ON l.rid = w.rid),
m AS (
  SELECT *, n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > {quality.MAX_REPEAT_PERCENT} * n_words AS base_failed,
    {_share("n_symbols", "word_chars")} AS symbols, {_share("n_dup_lines", "n_lines")} AS dup_lines, {_share("n_repeat_words", "n_words")} AS repeats,
    coalesce(CAST(10 * word_chars // nullif(n_words, 0) AS BIGINT), 0) AS word_length
  FROM c),
f AS (
  SELECT lang, source, whole, max(n) AS n,
    {", ".join(f"max(high + {quality.REACH} * (high - mid) + 1) FILTER (measure = '{x}') AS high_{x}" for x in _MEASURES)},
    max(low - {quality.REACH} * (mid - low) - 1) FILTER (measure = 'word_length') AS low_word_length
  FROM ({_fences()}) GROUP BY lang, source, whole)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  coalesce(NOT base_failed AND symbols <= x.high_symbols AND dup_lines <= x.high_dup_lines AND repeats <= x.high_repeats
    AND word_length BETWEEN x.low_word_length AND x.high_word_length, false) AS kept, n_lines,
  CAST(x.high_symbols AS BIGINT) AS high_symbols, CAST(x.high_dup_lines AS BIGINT) AS high_dup_lines, CAST(x.high_repeats AS BIGINT) AS high_repeats,
  CAST(x.low_word_length AS BIGINT) AS low_word_length, CAST(x.high_word_length AS BIGINT) AS high_word_length
FROM m
LEFT JOIN f own ON NOT own.whole AND own.lang IS NOT DISTINCT FROM m.lang AND own.source IS NOT DISTINCT FROM m.source
LEFT JOIN f x ON own.n IS NOT NULL AND x.lang IS NOT DISTINCT FROM m.lang AND x.whole = (own.n < {quality.MIN_GROUP})
  AND (x.whole OR x.source IS NOT DISTINCT FROM m.source)
"""



def _told(*values: str) -> str:
    """Digest of values written as a length, a colon and a text."""
    return "sha256(concat(" + ", ".join(f"CASE WHEN {v} IS NULL THEN '-' ELSE strlen(CAST({v} AS VARCHAR)) || ':' || CAST({v} AS VARCHAR) END" for v in values) + "))"


# CRC-32 of the id's decimal text, bit by bit.
_CRC = """xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(range(1, len(CAST(doc_id AS VARCHAR)) + 1), lambda i: CAST(ascii(CAST(doc_id AS VARCHAR)[i]) AS BIGINT))),
  lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)), lambda c, k: xor(c >> 1, 3988292384 * (c & 1)))))"""

MANIFEST = f"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS rid, doc_id, lang, {_told("doc_id", "source", "lang", "n_chars", "text")} AS leaf,
    CASE WHEN n_chars IS NOT NULL AND {_CRC} % 7 = 0 THEN {_told("doc_id", "source", "lang", "(n_chars + 1)", "text")} END AS changed
  FROM documents),
leaves AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY lang) AS n FROM d),
tree(lang, level, pos, h, n) AS (
  SELECT lang, 0, pos, leaf, n FROM leaves
  UNION ALL
  SELECT lang, level + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), (any_value(n) + 1) // 2 FROM tree WHERE n > 1 GROUP BY lang, level, pos // 2),
subroots AS (SELECT lang, h AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM tree WHERE n = 1),
upper(level, pos, h, n) AS (
  SELECT 0, pos, subroot, n FROM subroots
  UNION ALL
  SELECT level + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), (any_value(n) + 1) // 2 FROM upper WHERE n > 1 GROUP BY level, pos // 2),
path(rid, lang, level, pos, n, h, beside) AS (
  SELECT rid, lang, 0, pos, n, coalesce(changed, leaf), '' FROM leaves
  UNION ALL
  SELECT p.rid, p.lang, p.level + 1, p.pos // 2, (p.n + 1) // 2,
    sha256(CASE WHEN p.pos % 2 = 1 THEN coalesce(s.h, '') || p.h ELSE p.h || coalesce(s.h, '') END), p.beside || coalesce(s.h, '')
  FROM path p LEFT JOIN tree s ON s.lang IS NOT DISTINCT FROM p.lang AND s.level = p.level AND s.pos = xor(p.pos, 1) WHERE p.n > 1),
rest(rid, level, pos, n, h, beside) AS (
  SELECT p.rid, 0, s.pos, s.n, p.h, p.beside FROM path p JOIN subroots s ON s.lang IS NOT DISTINCT FROM p.lang WHERE p.n = 1
  UNION ALL
  SELECT p.rid, p.level + 1, p.pos // 2, (p.n + 1) // 2,
    sha256(CASE WHEN p.pos % 2 = 1 THEN coalesce(s.h, '') || p.h ELSE p.h || coalesce(s.h, '') END), p.beside || coalesce(s.h, '')
  FROM rest p LEFT JOIN upper s ON s.level = p.level AND s.pos = xor(p.pos, 1) WHERE p.n > 1)
SELECT d.doc_id, d.leaf, s.subroot, t.h AS root, sha256(r.beside) AS proof_sha256, r.h AS folded_root, r.h = t.h AS verified
FROM d JOIN subroots s ON s.lang IS NOT DISTINCT FROM d.lang JOIN rest r ON r.rid = d.rid AND r.n = 1 JOIN upper t ON t.n = 1
"""

NEGATIVES = f"""
WITH e AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor({negatives.SCALE} * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM e a JOIN e b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= {negatives.POSITIVES})
SELECT p.anchor_id, p.other AS positive_id, CAST(row_number() OVER (PARTITION BY p.anchor_id, p.other ORDER BY n.score DESC, n.other) AS INTEGER) AS rank,
  n.other AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM p JOIN s n ON n.anchor_id = p.anchor_id AND NOT n.same
  AND {negatives.FARTHEST} * p.score <= 100 * n.score AND 100 * n.score <= {negatives.CLOSEST} * p.score
QUALIFY rank <= {negatives.NEGATIVES}
"""

SQL = {"op12_hard_negatives": NEGATIVES, "op13_merkle_manifest": MANIFEST, "op4_warc": ARCHIVE, "op6_ngram_jaccard": JACCARD, "op9_quality_rules": QUALITY}
