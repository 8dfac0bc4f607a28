"""The registered queries in plain SQL, written independently of the Spark plans."""

from __future__ import annotations


def r6(expr: str, name: str, digits: int = 6) -> str:
    # Adding zero turns -0.0 into 0.0.
    return f"round({expr}, {digits}) + 0.0::DOUBLE AS {name}"


LI = "SELECT (l_returnflag = 'R')::INT AS label, l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem"
LI_X = (
    "SELECT (l_returnflag = 'R')::INT AS label, l_quantity AS x0, l_extendedprice AS x1, "
    "l_discount AS x2, l_tax AS x3, 'train' AS part FROM lineitem"
)
ORD = (
    "SELECT o_orderkey AS row_id, (o_orderstatus = 'F')::INT AS label, o_totalprice, c_acctbal, "
    "o_orderpriority, c_mktsegment FROM orders JOIN customer ON o_custkey = c_custkey"
)
DOC = (
    "SELECT d.doc_id AS row_id, l.quality AS label, d.n_chars, l.toxic, d.lang, d.source "
    "FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"
)
EMB = "SELECT vec_id AS row_id, (label = 0)::INT AS label, embedding::DOUBLE[] AS x FROM embeddings"

HALF = "CASE WHEN x0 <= 25.0 THEN 1 ELSE 2 END"


def rows_at(node: str, base: str = LI_X) -> str:
    """Rows of a node with gradient and hessian at margin one half."""
    p = "(1.0::DOUBLE / (1.0::DOUBLE + exp(-0.5::DOUBLE)))"
    return f"SELECT *, {node} AS node, {p} - label AS g, {p} * (1.0::DOUBLE - {p}) AS h FROM ({base})"


CUT = ", ".join(
    f"floor({c} * 67108864.0::DOUBLE)::BIGINT AS {c}1, "
    f"floor(({c} * 67108864.0::DOUBLE - floor({c} * 67108864.0::DOUBLE)) * 67108864.0::DOUBLE)::BIGINT AS {c}0"
    for c in ("g", "h")
)


def long_rows(source: str, features, where: str = "true") -> str:
    """One row per row and feature; gradients and hessians as multiples of 2^-26 and, of what is left, of 2^-52."""
    return " UNION ALL ".join(
        f"SELECT node, {i} AS f, x{i} AS v, {CUT} FROM {source} WHERE {where}" for i in features
    )


PARTS = ("g1", "g0", "h1", "h0")


def summed(suffix: str = "") -> str:
    """Sums of the parts, which are whole numbers, so their order does not matter."""
    return ", ".join(f"sum({c}{suffix}) AS {c}{suffix}" for c in PARTS)


def number(value: str, rest: str = "", minus: str | None = None) -> str:
    """The number that a pair of parts stands for, or that the difference of two pairs does."""
    one, none = (f"({value}{k}{rest} - {value}{k}{minus})" if minus else f"{value}{k}{rest}" for k in "10")
    return f"({one}::DOUBLE * {2.0**-26!r}::DOUBLE + {none}::DOUBLE * {2.0**-52!r}::DOUBLE)"


def sides(left: str, whole: str) -> str:
    """Left and right sums as numbers, from left parts and parts of the whole."""
    return ", ".join(
        f"{number(c, left)} AS {c}l, {number(c, whole, left)} AS {c}r" for c in ("g", "h")
    )


def gain(lam: float, gamma: float) -> str:
    return (
        f"0.5::DOUBLE * (gl * gl / nullif(hl + {lam}::DOUBLE, 0) + gr * gr / nullif(hr + {lam}::DOUBLE, 0) "
        f"- (gl + gr) * (gl + gr) / nullif(hl + hr + {lam}::DOUBLE, 0)) - {gamma}::DOUBLE"
    )


def over_parts(*more: str) -> str:
    """Running sums (window w) and whole sums (window t) of the parts and of the row count."""
    return ", ".join(f"sum({c}) OVER w AS {c}l, sum({c}) OVER t AS {c}a" for c in (*PARTS, *more))


def candidate_ctes(name: str, source: str, features, lam=1.0, gamma=0.0, where="true") -> str:
    """``<name>_cand``: every midpoint of neighbouring distinct values, with sums and gain."""
    return f"""
    {name}_hist AS (SELECT node, f, v, {summed()}, count(*) AS n
      FROM ({long_rows(source, features, where)}) GROUP BY node, f, v),
    {name}_run AS (SELECT node, f, v, lead(v) OVER w AS nv, {over_parts("n")} FROM {name}_hist
      WINDOW w AS (PARTITION BY node, f ORDER BY v ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
             t AS (PARTITION BY node, f)),
    {name}_side AS (SELECT node, f, (v + nv) / 2 AS split, {sides("l", "a")}, nl, na - nl AS nr
      FROM {name}_run WHERE nv IS NOT NULL),
    {name}_cand AS (SELECT *, {gain(lam, gamma)} AS gain FROM {name}_side)"""


def best_cte(name: str, rule: str = "true") -> str:
    return f"""
    {name} AS (SELECT * FROM {name}_cand WHERE gain IS NOT NULL AND {rule}
      QUALIFY row_number() OVER (PARTITION BY node ORDER BY gain DESC, f, split) = 1)"""


SPLIT_OUT = f"node, f, {r6('split', 'split')}, {r6('gain', 'gain')}, nl::BIGINT AS nl, nr::BIGINT AS nr"


def split_sql(node: str, features=range(4), rule: str = "true", having: str = "true") -> str:
    return (
        f"WITH r AS ({rows_at(node)}), {candidate_ctes('b', 'r', features)}, {best_cte('b', rule)} "
        f"SELECT {SPLIT_OUT} FROM b WHERE {having}"
    )


def histogram_sql(num_bins: int) -> str:
    k = num_bins

    def edge(j: str) -> str:
        return f"(lo + (hi - lo) * ({j}) / {k}::DOUBLE)"

    return f"""
    WITH r AS ({rows_at(HALF)}), lr AS ({long_rows('r', range(4))}),
    rg AS (SELECT *, min(v) OVER (PARTITION BY node, f) AS lo, max(v) OVER (PARTITION BY node, f) AS hi FROM lr),
    rough AS (SELECT *, least(greatest(floor((v - lo) / nullif(hi - lo, 0) * {k}), 0), {k - 1}) AS q FROM rg),
    binned AS (SELECT *, coalesce(q - CASE WHEN q > 0 AND v <= {edge('q')} THEN 1 ELSE 0 END
        + CASE WHEN q < {k - 1} AND v > {edge('q + 1')} THEN 1 ELSE 0 END, 0) AS b FROM rough),
    cells AS (SELECT node, f, b, lo, hi, {summed()}, count(*) AS n FROM binned GROUP BY ALL),
    run AS (SELECT *, {over_parts("n")} FROM cells
      WINDOW w AS (PARTITION BY node, f ORDER BY b ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
             t AS (PARTITION BY node, f)),
    side AS (SELECT node, f, {edge('b + 1')} AS split, {sides("l", "a")}, nl, na - nl AS nr
      FROM run WHERE b < {k - 1} AND na > nl),
    b_cand AS (SELECT *, {gain(1.0, 0.0)} AS gain FROM side), {best_cte('b')}
    SELECT {SPLIT_OUT} FROM b"""


def quantile_sql() -> str:
    points = "[" + ", ".join(f"{(i + 1) / 20}" for i in range(19)) + "]"
    return f"""
    WITH r AS ({rows_at(HALF)}), lr AS ({long_rows('r', range(4))}),
    cuts AS (SELECT DISTINCT f, unnest(q) AS split FROM (SELECT f, quantile_disc(v, {points}) AS q FROM lr GROUP BY f)),
    hist AS (SELECT node, f, v, {summed()}, count(*) AS n FROM lr GROUP BY node, f, v),
    whole AS (SELECT node, f, {", ".join(f"sum({c}) AS {c}a" for c in PARTS)}, sum(n) AS na FROM hist GROUP BY node, f),
    lefts AS (SELECT node, f, split, {", ".join(f"sum({c}) AS {c}l" for c in PARTS)}, sum(n) AS nl
      FROM hist JOIN cuts USING (f) WHERE v <= split GROUP BY node, f, split),
    side AS (SELECT node, f, split, {sides("l", "a")}, nl, na - nl AS nr
      FROM lefts JOIN whole USING (node, f) WHERE na > nl),
    b AS (SELECT *, {gain(1.0, 0.0)} AS gain FROM side)
    SELECT node, f, {r6('split', 'split')}, {r6('gain', 'gain')}, nl::BIGINT AS nl, nr::BIGINT AS nr FROM b WHERE gain IS NOT NULL"""


def weighted_cuts_sql() -> str:
    p = "(1.0::DOUBLE / (1.0::DOUBLE + exp(-(0.5::DOUBLE + l_discount * 40.0::DOUBLE - l_tax * 20.0::DOUBLE))))"
    names = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
    weighed = " UNION ALL ".join(
        f"SELECT {i} AS f, {c}::DOUBLE AS v, floor({p} * (1.0::DOUBLE - {p}) * 67108864.0::DOUBLE)::BIGINT AS w FROM lineitem" for i, c in enumerate(names)
    )
    points = ", ".join(f"({(i + 1) / 20}::DOUBLE)" for i in range(19))
    return f"""
    WITH s AS (SELECT f, v, sum(w) AS w FROM ({weighed}) GROUP BY f, v),
    r AS (SELECT *, sum(w) OVER (PARTITION BY f ORDER BY v) AS upto, sum(w) OVER (PARTITION BY f) AS whole FROM s)
    SELECT DISTINCT f, min(v) AS cut FROM r, (VALUES {points}) t(p) WHERE upto >= greatest(1, ceil(round(p * whole::DOUBLE, 6))) GROUP BY f, p"""


def fit_ctes(base: str, k: int, trees: int, depth: int, lr=0.1, lam=1.0, gamma=0.0, min_gain=None, p="") -> str:
    """Boosting unrolled: ``<p>m<T>`` holds the margins after all trees and ``out<t>`` the tree outputs.

    Rows with part = 'test' are sent down the trees but do not shape them.
    """
    rule = "true" if min_gain is None else f"gain > {min_gain}::DOUBLE"
    ctes = [f"{p}m0 AS MATERIALIZED (SELECT *, 0.5::DOUBLE AS margin FROM ({base}))"]
    for t in range(trees):
        s = "(1.0::DOUBLE / (1.0::DOUBLE + exp(-margin)))"
        ctes.append(
            f"{p}r{t}_0 AS MATERIALIZED (SELECT *, 1 AS node, {s} - label AS g, {s} * (1.0::DOUBLE - {s}) AS h FROM {p}m{t})"
        )
        for d in range(depth):
            name, rows = f"{p}b{t}_{d}", f"{p}r{t}_{d}"
            ctes.append(candidate_ctes(name, rows, range(k), lam, gamma, f"part = 'train' AND node >= {2 ** d}"))
            # The threshold applies to the best candidate, so it follows the choice.
            ctes.append(best_cte(name))
            value = "CASE s.f " + " ".join(f"WHEN {i} THEN r.x{i}" for i in range(k)) + " END"
            ctes.append(
                f"{p}r{t}_{d + 1} AS MATERIALIZED (SELECT r.* EXCLUDE (node), CASE WHEN s.node IS NULL THEN r.node "
                f"WHEN {value} <= s.split THEN 2 * r.node ELSE 2 * r.node + 1 END AS node "
                f"FROM {rows} r LEFT JOIN (SELECT * FROM {name} WHERE {rule}) s ON r.node = s.node)"
            )
        ctes.append(
            f"{p}l{t} AS (SELECT node, n, -{number('g')} / ({number('h')} + {lam}::DOUBLE) AS val FROM (SELECT node, count(*) AS n, {summed()} "
            f"FROM (SELECT node, {CUT} FROM {p}r{t}_{depth} WHERE part = 'train') GROUP BY node))"
        )
        ctes.append(
            f"{p}m{t + 1} AS MATERIALIZED (SELECT r.* EXCLUDE (node, g, h, margin), r.margin + {lr}::DOUBLE * l.val AS margin, "
            f"l.val AS out{t} FROM {p}r{t}_{depth} r JOIN {p}l{t} l ON r.node = l.node)"
        )
    return ",\n".join(ctes)


def losses_sql(trees: int, p: str = "") -> str:
    return " UNION ALL ".join(
        f"SELECT {t} AS tree_id, sqrt(avg((label - out{t}) * (label - out{t}))) AS loss FROM {p}m{trees}"
        for t in range(trees)
    )


def tree_nodes_sql() -> str:
    inner = " UNION ALL ".join(
        f"SELECT s.node::BIGINT AS node_id, {d} AS depth, (s.nl + s.nr)::BIGINT AS n_rows, s.f AS var_idx, "
        f"{r6('s.split', 'split')}, {r6('s.gain', 'gain')}, NULL::DOUBLE AS val, "
        f"(2 * s.node)::BIGINT AS left, (2 * s.node + 1)::BIGINT AS right, false AS is_leaf FROM b0_{d} s"
        for d in (0, 1)
    )
    leaf = (
        "SELECT node, CASE WHEN node >= 4 THEN 2 WHEN node >= 2 THEN 1 ELSE 0 END, n, NULL, NULL, NULL, "
        f"{r6('val', 'val')}, NULL, NULL, true FROM l0"
    )
    return f"WITH {fit_ctes(LI_X, 4, 1, 2)} {inner} UNION ALL {leaf}"


# The fixed small model, tree by tree.
LEAF0 = "CASE WHEN l_extendedprice <= 30000.0 THEN CASE WHEN l_quantity <= 12.0 THEN 4 ELSE 5 END ELSE 3 END"
VALUE0 = f"CASE {LEAF0} WHEN 4 THEN -1.25::DOUBLE WHEN 5 THEN 0.5::DOUBLE ELSE 0.75::DOUBLE END"
VALUE1 = "CASE WHEN l_discount <= 0.05 THEN -0.5::DOUBLE ELSE 1.5::DOUBLE END"
SCORED = (
    f"SELECT *, 1.0::DOUBLE / (1.0::DOUBLE + exp(-(0.4::DOUBLE * {VALUE0} + 0.4::DOUBLE * {VALUE1}))) AS probability "
    f"FROM ({LI})"
)
LI_NAMES = "l_quantity, l_extendedprice, l_discount, l_tax"
COUNTS = (
    "SELECT count(*) FILTER (label = 0 AND probability < 0.5) AS tn, count(*) FILTER (label = 0 AND probability >= 0.5) AS fp, "
    "count(*) FILTER (label = 1 AND probability < 0.5) AS fn, count(*) FILTER (label = 1 AND probability >= 0.5) AS tp FROM "
)
SHARES = (
    "SELECT *, tn + fp + fn + tp AS n, (tp + tn)::DOUBLE / nullif(tn + fp + fn + tp, 0) AS accuracy, "
    "tp::DOUBLE / nullif(tp + fp, 0) AS precision, tp::DOUBLE / nullif(tp + fn, 0) AS recall FROM "
)
MEASURED = f"{SHARES} ({COUNTS} ({SCORED}))"
MEASURES = f"n, {r6('accuracy', 'accuracy')}, {r6('precision', 'precision')}, {r6('recall', 'recall')}"


def drawn(row_id: str, seed: int) -> str:
    return f"row_number() OVER (ORDER BY md5({row_id}::VARCHAR || ':{seed}'), {row_id}::VARCHAR)"


SPLIT = (
    f"SELECT *, CASE WHEN {drawn('row_id', 0)} <= count(*) OVER () - floor(count(*) OVER () * 0.2::DOUBLE) "
    f"THEN 'train' ELSE 'test' END AS part FROM ({ORD})"
)


def encoded(source: str, column: str, label: str = "label") -> str:
    w = "(1.0::DOUBLE / (1.0::DOUBLE + exp(-(n - 20.0::DOUBLE) / 10.0::DOUBLE)))"
    return (
        f"SELECT {column} AS cat, prior * (1.0::DOUBLE - {w}) + mean * {w} AS enc FROM "
        f"(SELECT {column}, count(*) AS n, avg({label}) AS mean FROM {source} GROUP BY {column}), "
        f"(SELECT avg({label}) AS prior FROM {source})"
    )


def knn_cte(points: str, k: int) -> str:
    """Neighbours within a class of ``points(row_id, label, x)``."""
    return f"""
    pairs AS (SELECT a.row_id, a.label, b.row_id AS nn_id, list_distance(a.x, b.x) AS distance
      FROM {points} a JOIN {points} b ON a.label = b.label AND a.row_id <> b.row_id),
    near AS (SELECT *, row_number() OVER (PARTITION BY row_id ORDER BY distance, nn_id) AS rank FROM pairs
      QUALIFY row_number() OVER (PARTITION BY row_id ORDER BY distance, nn_id) <= {k})"""


def synthetic_ctes(points: str, seed: int = 42, k: int = 5) -> str:
    """``made``: synthetic rows for class 1 or 0, whichever is smaller, from ``points(row_id, label, x)``."""
    h = f"md5(i::VARCHAR || ':' || y::VARCHAR || ':{seed}')"
    return f"""
    sizes AS (SELECT label AS y, count(*) AS n FROM {points} GROUP BY label),
    small AS (SELECT y, n, (SELECT max(n) FROM sizes) - n AS m FROM sizes WHERE n < (SELECT max(n) FROM sizes)),
    minor AS MATERIALIZED (SELECT * FROM {points} WHERE label IN (SELECT y FROM small)),
    {knn_cte('minor', k)},
    places AS (SELECT *, {drawn('row_id', seed)} - 1 AS place FROM minor),
    draws AS (SELECT i, y, n, ('0x' || substr({h}, 1, 15))::BIGINT % (n * {k}) AS pick,
        ('0x' || substr({h}, 16, 13))::BIGINT::DOUBLE / 4503599627370496.0::DOUBLE AS u
      FROM (SELECT y, n, unnest(range(m)) AS i FROM small)),
    made AS (SELECT -1 - d.i AS row_id, d.y AS label, [z[1] + d.u * (z[2] - z[1]) for z in list_zip(p.x, q.x)] AS x
      FROM draws d JOIN places p ON p.place = d.pick // {k}
      JOIN near ON near.row_id = p.row_id AND near.rank = d.pick % {k} + 1
      JOIN minor q ON q.row_id = near.nn_id)"""


EMB_OUT = ", ".join(r6(f"x[{i + 1}]", f"embedding_{i}") for i in range(64))

PREP_SQL = f"""
WITH raw AS (SELECT row_id, o_orderpriority, c_mktsegment, o_totalprice,
    CASE WHEN c_acctbal >= 0.0 THEN c_acctbal END AS balance, label FROM ({ORD})),
  filled AS MATERIALIZED (SELECT * EXCLUDE (balance), coalesce(balance, (SELECT median(balance) FROM raw)) AS balance FROM raw),
  e1 AS ({encoded('filled', 'o_orderpriority')}), e2 AS ({encoded('filled', 'c_mktsegment')}),
  coded AS (SELECT row_id, label, [e1.enc, e2.enc, o_totalprice, balance] AS x,
      CASE WHEN {drawn('row_id', 42)} <= count(*) OVER () - floor(count(*) OVER () * 0.2::DOUBLE)
        THEN 'train' ELSE 'test' END AS part
    FROM filled JOIN e1 ON e1.cat = o_orderpriority JOIN e2 ON e2.cat = c_mktsegment),
  train AS MATERIALIZED (SELECT row_id, label, x FROM coded WHERE part = 'train'),
  {synthetic_ctes('train')},
  everything AS (SELECT row_id, label, x, false AS synthetic, part FROM coded
    UNION ALL SELECT row_id, label, x, true, 'train' FROM made)
SELECT row_id, label, synthetic, part, {r6('x[1]', 'o_orderpriority')}, {r6('x[2]', 'c_mktsegment')},
  {r6('x[3]', 'o_totalprice')}, {r6('x[4]', 'balance')} FROM everything
"""

SQL: dict[str, str] = {
    "grad_hess": f"""
        WITH p AS (SELECT *, (l_returnflag = 'R')::INT AS label, 1.0::DOUBLE / (1.0::DOUBLE +
            exp(-(0.5::DOUBLE + l_discount * 10.0::DOUBLE - l_tax * 10.0::DOUBLE))) AS s FROM lineitem)
        SELECT l_orderkey, l_partkey, l_linenumber, {r6('s - label', 'g')}, {r6('s * (1.0::DOUBLE - s)', 'h')} FROM p""",
    "node_hist": f"""
        WITH r AS ({rows_at(HALF)}), lr AS ({long_rows('r', range(4))})
        SELECT node, f, v, {r6(number('g'), 'g')}, {r6(number('h'), 'h')}, n FROM (SELECT node, f, v, {summed()}, count(*) AS n FROM lr GROUP BY node, f, v)""",
    "split_candidates": f"""
        WITH r AS ({rows_at('0')}), {candidate_ctes('c', 'r', range(4))}
        SELECT node, f, {r6('split', 'split')}, {r6('gain', 'gain')},
          nl::BIGINT AS nl, nr::BIGINT AS nr FROM c_cand""",
    "split_root": split_sql("0"),
    "split_level": split_sql(HALF),
    "split_min_gain": split_sql(HALF, having="gain > 0"),
    "split_constrained": split_sql(HALF, rule="nl >= 1500 AND nr >= 1500 AND hl > 400 AND hr > 400"),
    "split_histogram": histogram_sql(10),
    "weighted_cuts": weighted_cuts_sql(),
    "split_quantile": quantile_sql(),
    "split_col_sample": f"""
        WITH r AS ({rows_at('0')}), {candidate_ctes('b_all', 'r', range(4))},
        b_cand AS (SELECT * FROM b_all_cand WHERE f IN
          (SELECT i FROM range(4) t(i) ORDER BY md5('7:0:' || i::VARCHAR) LIMIT 2)),
        {best_cte('b')} SELECT {SPLIT_OUT} FROM b""",
    "leaf_values": f"""
        SELECT node, count(*) AS n, {r6('-sum(g) / (sum(h) + 1.0::DOUBLE)', 'value')} FROM ({rows_at(HALF)}) GROUP BY node""",
    "tree_nodes": tree_nodes_sql(),
    "fit_loss": f"WITH {fit_ctes(LI_X, 4, 2, 1)} SELECT tree_id, {r6('loss', 'loss')} FROM ({losses_sql(2)})",
    "training_time": "SELECT i::INT AS tree_id, true AS timed, true AS adds_up, true AS written FROM range(2) t(i)",
    "strategy_loss": f"""
        WITH {fit_ctes(LI_X, 4, 2, 2, p='a_')}, {fit_ctes(LI_X, 4, 2, 2, gamma=2.0, min_gain=0.0, p='p_')}
        SELECT tree_id, {r6('a.loss', 'plain')}, {r6('b.loss', 'positive')}
        FROM ({losses_sql(2, 'a_')}) a JOIN ({losses_sql(2, 'p_')}) b USING (tree_id)""",
    "predict_leaf": f"SELECT {LI_NAMES}, ({LEAF0})::BIGINT AS leaf, {r6(VALUE0, 'leaf_value')} FROM ({LI})",
    "predict_proba": f"SELECT {LI_NAMES}, {r6('probability', 'probability')} FROM ({SCORED})",
    "classify": f"""
        SELECT {LI_NAMES}, (probability >= 0.5)::INT AS predicted, round(probability)::INT AS rounded FROM ({SCORED})""",
    "score_stream": f"""
        SELECT event_id, (event_type = 'purchase')::INT AS label, {r6(
            "1.0::DOUBLE / (1.0::DOUBLE + exp(-(CASE WHEN extract(hour FROM ts) <= 11 THEN -0.25::DOUBLE ELSE 0.75::DOUBLE END)))",
            'probability')} FROM events""",
    "confusion": f"{COUNTS} ({SCORED})",
    "metrics": f"SELECT {MEASURES} FROM ({MEASURED})",
    "metrics_swapped": f"SELECT n, {r6('accuracy', 'accuracy')}, {r6('recall', 'precision')}, {r6('precision', 'recall')} FROM ({MEASURED})",
    "metrics_text": f"""
        SELECT printf('%.2f%%', accuracy * 100) AS accuracy, printf('%.2f%%', precision * 100) AS precision,
          printf('%.2f%%', recall * 100) AS recall FROM ({MEASURED})""",
    "log_odds": f"""
        SELECT {r6("ln(count(*) FILTER (label = 1)::DOUBLE / count(*) FILTER (label <> 1))", 'log_odds')} FROM ({LI})""",
    "train_test_split": f"SELECT row_id, label, part FROM ({SPLIT})",
    "row_sample": f"""
        SELECT row_id, o_totalprice FROM ({ORD})
        QUALIFY {drawn('row_id', 3)} <= floor(count(*) OVER () * 0.35::DOUBLE + 0.5)""",
    "sort_column": """
        SELECT o_orderkey, o_totalprice, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS rank FROM orders""",
    "sort_column_ascending": """
        SELECT o_orderkey, o_totalprice, row_number() OVER (ORDER BY o_totalprice, o_orderkey) AS rank FROM orders""",
    "merge_sorted": """
        SELECT *, row_number() OVER (ORDER BY v, src, o_orderkey) AS rank FROM (
          SELECT o_orderkey, o_totalprice AS v, 0 AS src FROM orders
          UNION ALL SELECT c_custkey, c_acctbal, 1 FROM customer)""",
    "value_rank": """
        SELECT *, floor(log2(rank))::INT AS power FROM (SELECT o_orderkey, floor(o_totalprice / 1000)::BIGINT AS v,
          row_number() OVER (ORDER BY floor(o_totalprice / 1000), o_orderkey DESC) AS rank FROM orders)""",
    "null_rates": f"""
        WITH d AS ({DOC}) """ + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, {r6(f'100.0::DOUBLE * count(*) FILTER ({c} IS NULL) / count(*)', 'null_percent')} FROM d"
        for c in ("row_id", "label", "n_chars", "toxic", "lang", "source")
    ),
    "drop_sparse": f"SELECT row_id, n_chars, lang, source FROM ({DOC})",
    "label_distribution": f"""
        WITH c AS (SELECT label, count(*) AS n FROM ({DOC}) WHERE label IS NOT NULL GROUP BY label)
        SELECT label, n, {r6('100.0::DOUBLE * n / (SELECT sum(n) FROM c)', 'percent')},
          printf('%.2f%%', 100.0::DOUBLE * n / (SELECT sum(n) FROM c)) AS percent_text FROM c""",
    "class_counts": f"""
        WITH c AS (SELECT label, count(*) AS n FROM ({EMB}) GROUP BY label)
        SELECT 'before' AS stage, label, n FROM c UNION ALL SELECT 'after', label, (SELECT max(n) FROM c) FROM c""",
    "impute": f"""
        WITH d AS ({DOC}),
        lc AS (SELECT lang, count(*) AS n FROM d WHERE lang IS NOT NULL GROUP BY lang),
        sc AS (SELECT source, count(*) AS n FROM d WHERE source IS NOT NULL GROUP BY source)
        SELECT row_id, coalesce(label, (SELECT median(label) FROM d))::DOUBLE AS label,
          coalesce(n_chars, (SELECT median(n_chars) FROM d))::DOUBLE AS n_chars,
          coalesce(toxic, (SELECT median(toxic) FROM d))::DOUBLE AS toxic,
          coalesce(lang, (SELECT lang FROM lc ORDER BY n DESC, lang LIMIT 1)) AS lang,
          coalesce(source, (SELECT source FROM sc ORDER BY n DESC, source LIMIT 1)) AS source FROM d""",
    "na_sentinel": f"""
        SELECT row_id, coalesce(label::DOUBLE, -1e-17::DOUBLE) * 1e17::DOUBLE AS label_e17,
          coalesce(toxic::DOUBLE, -1e-17::DOUBLE) * 1e17::DOUBLE AS toxic_e17, n_chars::DOUBLE AS n_chars,
          coalesce(label, 0)::INT AS label_int FROM ({DOC})""",
    "csv_roundtrip": f"SELECT row_id, label, o_totalprice, c_acctbal FROM ({ORD})",
    "zip_labels": f"SELECT row_id, o_totalprice, label FROM ({ORD})",
    "read_table": "SELECT * FROM customer",
    "run_log": f"""
        SELECT tn, fp, fn, tp, {r6('accuracy', 'accuracy')}, '0.4' AS arg_learning_rate, 0.2::DOUBLE AS test_size
        FROM ({MEASURED}), range(2)""",
    "standardize": f"SELECT label, " + ", ".join(
        r6(f"({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER ()", c) for c in LI_NAMES.split(", ")
    ) + f" FROM ({LI})",
    "one_hot": "SELECT row_id, label, " + ", ".join(
        f"(c_mktsegment = '{s}')::INT AS \"c_mktsegment_{s}\""
        for s in ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
    ) + f" FROM ({ORD})",
    "one_hot_sparse": """
        SELECT l_orderkey * 8 + l_linenumber AS row_id, dense_rank() OVER (ORDER BY l_partkey) - 1 AS index, 1 AS value FROM lineitem""",
    "drop_columns": f"SELECT n_chars, lang, source, label FROM ({DOC})",
    "drop_null_rows": f"""
        SELECT * FROM ({DOC}) WHERE label IS NOT NULL AND n_chars IS NOT NULL AND toxic IS NOT NULL
          AND lang IS NOT NULL AND source IS NOT NULL""",
    "head_rows": f"SELECT * FROM ({DOC}) ORDER BY row_id LIMIT 100",
    "target_encode": f"""
        WITH d AS ({ORD}), e1 AS ({encoded('d', 'o_orderpriority')}), e2 AS ({encoded('d', 'c_mktsegment')})
        SELECT row_id, {r6('e1.enc', 'o_orderpriority')}, {r6('e2.enc', 'c_mktsegment')}
        FROM d JOIN e1 ON e1.cat = o_orderpriority JOIN e2 ON e2.cat = c_mktsegment""",
    "knn": f"""
        WITH pts AS ({EMB}), {knn_cte('pts', 5)}
        SELECT row_id, label, rank::INT AS rank, nn_id, {r6('distance', 'distance')} FROM near""",
    "oversample": f"""
        WITH pts AS ({EMB}), {synthetic_ctes('pts')},
        everything AS (SELECT row_id, label, false AS synthetic, x FROM pts
          UNION ALL SELECT row_id, label, true, x FROM made)
        SELECT row_id, label, synthetic, {EMB_OUT} FROM everything""",
    "prep_clean": PREP_SQL,
    "run_from_files": f"""
        WITH numbered AS (SELECT row_number() OVER (ORDER BY row_id) - 1 AS row_id, label, o_totalprice AS x0, c_acctbal AS x1 FROM ({ORD})),
        base AS (SELECT *, CASE WHEN {drawn('row_id', 0)} <= count(*) OVER () - floor(count(*) OVER () * 0.2::DOUBLE)
          THEN 'train' ELSE 'test' END AS part FROM numbered),
        {fit_ctes('SELECT * FROM base', 2, 2, 2)},
        scored AS (SELECT label, 1.0::DOUBLE / (1.0::DOUBLE + exp(-(margin - 0.5::DOUBLE))) AS probability
          FROM m2 WHERE part = 'test')
        SELECT tree_id, {r6('loss', 'loss')}, tn, fp, fn, tp, {MEASURES} FROM ({losses_sql(2).replace("FROM m2", "FROM m2 WHERE part = 'train'")}), ({SHARES} ({COUNTS} scored))""",
    "usual_configuration": f"""
        WITH numbered AS (SELECT row_number() OVER (ORDER BY row_id) - 1 AS row_id, label, o_totalprice AS x0, c_acctbal AS x1 FROM ({ORD})),
        base AS (SELECT *, CASE WHEN {drawn('row_id', 0)} <= count(*) OVER () - floor(count(*) OVER () * 0.2::DOUBLE)
          THEN 'train' ELSE 'test' END AS part FROM numbered),
        {fit_ctes('SELECT * FROM base', 2, 10, 8, lam=0.0)},
        scored AS (SELECT label, 1.0::DOUBLE / (1.0::DOUBLE + exp(-(margin - 0.5::DOUBLE))) AS probability FROM m10 WHERE part = 'test'),
        sizes AS ({" UNION ALL ".join(f"SELECT {t} AS tree_id, 2 * count(*) - 1 AS nodes, count(*) AS leaves FROM l{t}" for t in range(10))}),
        losses AS ({losses_sql(10).replace("FROM m10", "FROM m10 WHERE part = 'train'")})
        SELECT tree_id, nodes, leaves, {r6('loss', 'loss')}, tn, fp, fn, tp, {MEASURES.removeprefix("n, ")}
        FROM sizes JOIN losses USING (tree_id), ({SHARES} ({COUNTS} scored))""",
    "end_to_end": f"""
        WITH base AS (SELECT row_id, label, o_totalprice AS x0, c_acctbal AS x1, part FROM ({SPLIT})),
        {fit_ctes('SELECT * FROM base', 2, 2, 2)},
        scored AS (SELECT label, 1.0::DOUBLE / (1.0::DOUBLE + exp(-(margin - 0.5::DOUBLE))) AS probability
          FROM m2 WHERE part = 'test')
        SELECT tn, fp, fn, tp, {MEASURES} FROM ({SHARES} ({COUNTS} scored))""",
}
