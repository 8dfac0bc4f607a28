"""Split search, growth, fitting and scoring against a plain model on few rows."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

import brute
from copse.operators import bins, splits, tree
from copse.operators.select import order_statistics
from copse.operators.tree import sample_columns
from copse.params import BoostParams
from copse.plans import views
from copse.plans.boost import BoostedModel, fit, fit_each

LI = views.LI_FEATURES


def params(**changes):
    return BoostParams(**{**dict(trees=2, depth=3, learning_rate=0.3, gamma=0.0, subsample_cols=1.0), **changes})


def nodes_of(model, tree_id):
    return {r[1]: r for r in model.node_rows() if r[0] == tree_id}


def check_same(model, expected):
    for tree_id, tree in enumerate(expected):
        got = nodes_of(model, tree_id)
        assert set(got) == set(tree)
        for node, want in tree.items():
            row = got[node]
            assert row[3] == want["n"]
            if "f" in want:
                assert row[4] == want["f"] and row[5] == pytest.approx(want["split"])
                assert row[6] == pytest.approx(want["gain"], abs=1e-8)
            else:
                assert row[10] and row[7] == pytest.approx(want["val"])


@pytest.mark.parametrize("rules", [{}, {"min_gain": 0.0}, {"min_leaf": 20, "min_child_weight": 6.0}])
def test_fit_matches_plain_model(sample, rules):
    df, x, y = sample
    model = fit(df, LI, "label", params(**rules, gamma=0.5))
    expected, losses = brute.fit(x, y, 2, 3, 0.3, 1.0, 0.5, **rules)
    check_same(model, expected)
    assert model.losses == pytest.approx(losses)
    scored = model.predict_proba(df).select(*LI, "probability").toPandas()
    want = brute.probability(expected, scored[LI].to_numpy(float), 0.3)
    assert scored["probability"].to_numpy() == pytest.approx(want)


def test_block_search_and_refinement_equal_plain_search(spark, sample, monkeypatch):
    df, x, y = sample
    expected, _ = brute.fit(x, y, 2, 3, 0.3, 1.0, 0.0)
    check_same(fit(df, LI, "label", params()), expected)
    monkeypatch.setattr(bins, "BLOCK_QUANTILES", 4)
    monkeypatch.setattr(splits, "SUB_QUANTILES", 3)
    monkeypatch.setattr(splits.exact_best, "__defaults__", (8, 3))
    check_same(fit(df, LI, "label", params()), expected)


def test_partitioning_does_not_matter(sample):
    df, _, _ = sample
    a = fit(df.coalesce(1), LI, "label", params())
    b = fit(df.repartition(7), LI, "label", params())
    assert [r[:6] for r in a.node_rows()] == [r[:6] for r in b.node_rows()]


@pytest.mark.parametrize("method", ["exact", "quantile", "histogram"])
def test_same_tree_on_any_partitioning(spark, folder, method):
    """Deep, without regularization, on rows with many ties: to the last digit."""
    df = views.ord_xy(spark, folder).select("label", "o_totalprice", (F.col("c_acctbal") / 100).cast("int").alias("b"))
    depth = 8 if method == "exact" else 4
    config = params(trees=1, depth=depth, reg_lambda=0.0, method=method, eps=0.05, num_bins=8)
    found = [fit(df.repartition(n, "o_totalprice"), ["o_totalprice", "b"], "label", config) for n in (1, 8, 64)]
    assert found[0].node_rows() == found[1].node_rows() == found[2].node_rows()
    assert max(r[2] for r in found[0].node_rows()) == depth


def test_cells_of_siblings_are_what_is_left(spark, sample):
    df, x, _ = sample
    rows = df.select(*[F.col(c).alias(f"x{i}") for i, c in enumerate(LI)], (F.col("l_tax") * 0.37 - 0.01).alias("g"), (F.col("l_discount") + 0.1).alias("h"))
    rows = rows.withColumns({f"b{i}": (F.col(f"x{i}") * 10 % 7).cast("int") for i in range(2)})
    parent = splits.cut_cells(rows.withColumn("node", (F.col("x0") > 30).cast("int")), [0, 1])
    child = F.when(F.col("x0") > 30, F.when(F.col("x1") > 30000, 4).otherwise(3)).otherwise(F.when(F.col("x1") > 20000, 6).otherwise(5))
    below = rows.withColumn("node", child)
    whole = splits.cut_cells(below, [0, 1])
    got = splits.with_siblings(splits.cut_cells(below.filter("node IN (3, 6)"), [0, 1]), parent, {1: (3, 4), 0: (6, 5)})
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, whole.collect()))


@pytest.mark.parametrize("carried", [1, 2])
def test_nodes_written_between_levels(sample, monkeypatch, carried):
    from copse.operators import tree

    df, x, y = sample
    monkeypatch.setattr(tree, "CARRIED_LEVELS", carried)
    expected, _ = brute.fit(x, y, 1, 4, 0.3, 1.0, 0.0)
    check_same(fit(df, LI, "label", params(trees=1, depth=4)), expected)


def test_undefined_output(spark):
    """Without regularization a leaf of rows that weigh nothing has no output; later trees have no split and no output either."""
    df = spark.createDataFrame([(1.0, 1), (2.0, 0)], "x double, label int")
    model = fit(df, ["x"], "label", params(trees=2, depth=1, reg_lambda=0.0, train_margin=800.0))
    assert model.trees[0].value[0] is None and len(model.trees[1].heap) == 1 and math.isnan(model.trees[1].value[0])
    assert math.isnan(model.predict_proba(df).first()["probability"])


def test_children_add_up_and_every_row_has_one_leaf(sample):
    df, _, _ = sample
    model = fit(df, LI, "label", params())
    nodes = nodes_of(model, 0)
    for node, row in nodes.items():
        if not row[10]:
            assert nodes[2 * node][3] + nodes[2 * node + 1][3] == row[3]
    leaves = {r["leaf"]: r["count"] for r in model.predict_leaf(df, 0).groupBy("leaf").count().collect()}
    assert leaves == {n: r[3] for n, r in nodes.items() if r[10]}


def test_histogram_equals_exact_partition_for_few_values(spark):
    # Values 0..9 in ten bins: each value has a bin of its own.
    rows = [(float(i % 10), int((i * 7) % 10 > 4 or i % 3 == 0)) for i in range(300)]
    df = spark.createDataFrame(rows, "x double, label int")
    exact = fit(df, ["x"], "label", params(depth=1, trees=1))
    hist = fit(df, ["x"], "label", params(depth=1, trees=1, method="histogram", num_bins=10))
    assert [r[3] for r in exact.node_rows()] == [r[3] for r in hist.node_rows()]
    assert exact.node_rows()[0][6] == pytest.approx(hist.node_rows()[0][6])


@pytest.mark.parametrize("partitions", [1, 16])
def test_quantile_cuts_are_exact_on_any_partitioning(spark, folder, partitions):
    li = views.li_xy(spark, folder).repartition(partitions)
    points = bins.eps_points(0.05)
    assert points == pytest.approx([0.05 * i for i in range(1, 20)])
    cuts = bins.quantile_cuts(li, list(LI), points)
    for c, found in zip(LI, cuts):
        values = np.sort(li.select(c).toPandas()[c].to_numpy())
        assert found == sorted({values[math.ceil(round(p * len(values), 6)) - 1] for p in points})


def test_order_statistics_of_odd_values(spark):
    tiny, huge = 5e-324, 1.7e308
    values = [0.0, -0.0, 1.0, 1.0, 1.0, -1.0, tiny, -tiny, 2 * tiny, huge, -huge, math.inf, -math.inf, math.nan, None, 0.1, 0.1 + 1e-17, 1e-300, 3.0]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    plain = sorted(v for v in values if v is not None and not math.isnan(v))
    got = order_statistics(df, [F.col("v"), F.col("v") * 0], lambda n: range(n))
    assert got[0] == plain and len(got[1]) == 15
    assert order_statistics(df.filter("v is null"), [F.col("v")], lambda n: [0]) == [[]]
    ends = spark.createDataFrame([(1.7976931348623157e308,), (math.inf,), (-5e-324,), (-0.0,)], "v double")
    assert order_statistics(ends, [F.col("v")], lambda n: range(n)) == [[-5e-324, 0.0, 1.7976931348623157e308, math.inf]]


@pytest.mark.parametrize("seed", range(2))
def test_order_statistics_of_random_bits(spark, seed):
    """Doubles of any exponent, many equal: every rank, in six rounds at most (the search ends by itself)."""
    rng = np.random.default_rng(seed)
    values = rng.integers(0, 2**64, 400, dtype=np.uint64).view(np.float64)
    values = np.concatenate([values[np.isfinite(values)], rng.integers(-3, 3, 200) * 0.1])
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    plain = (np.sort(values) + 0.0).tolist()
    got = order_statistics(df, [F.col("v"), -F.col("v")], lambda n: [0, 7, n // 2, n - 1], rounds=6)
    n = len(plain)
    assert got == [[plain[i] for i in (0, 7, n // 2, n - 1)], [-plain[n - 1 - i] + 0.0 for i in (0, 7, n // 2, n - 1)]]


def test_weighted_order_statistics(spark):
    rng = np.random.default_rng(5)
    values, weights = rng.normal(size=300).round(2), rng.integers(0, 9, 300)
    df = spark.createDataFrame([(float(v), int(w)) for v, w in zip(values, weights)], "v double, w long")
    plain = np.sort(np.repeat(values, weights)) + 0.0
    wanted = [0, 1, 500, len(plain) - 1]
    assert order_statistics(df, [F.col("v")], lambda n: wanted if n == len(plain) else [], weight=F.col("w")) == [[plain[i] for i in wanted]]


def test_weighted_cuts_follow_the_hessian(sample):
    df, _, _ = sample
    by_weight = fit(df, LI, "label", params(method="quantile", eps=0.1, weighted=True, learning_rate=1.0))
    by_number = fit(df, LI, "label", params(method="quantile", eps=0.1, learning_rate=1.0))
    assert by_weight.node_rows()[0] == by_number.node_rows()[0]
    leaves = {r["leaf"]: r["count"] for r in by_weight.predict_leaf(df, 1).groupBy("leaf").count().collect()}
    assert leaves == {n: r[3] for n, r in nodes_of(by_weight, 1).items() if r[10]}
    with pytest.raises(ValueError, match="weighted"):
        params(weighted=True)


def test_quantile_splits_are_consistent_with_routing(sample):
    df, _, _ = sample
    model = fit(df, LI, "label", params(method="quantile", eps=0.1))
    leaves = {r["leaf"]: r["count"] for r in model.predict_leaf(df, 1).groupBy("leaf").count().collect()}
    assert leaves == {n: r[3] for n, r in nodes_of(model, 1).items() if r[10]}


def test_nan_goes_right_and_is_never_split_off(spark):
    nan = float("nan")
    rows = [(1.0, 0), (2.0, 0), (3.0, 1), (nan, 1), (nan, 1), (4.0, 1)]
    df = spark.createDataFrame(rows, "x double, label int")
    model = fit(df, ["x"], "label", params(trees=1, depth=1))
    root = model.node_rows()[0]
    assert root[5] == 2.5
    got = model.predict_leaf(df, 0).filter("isnan(x)").select("leaf").distinct().collect()
    assert [r[0] for r in got] == [3]
    tail = spark.createDataFrame([(1.0, 0), (nan, 1), (nan, 1)], "x double, label int")
    assert fit(tail, ["x"], "label", params(trees=1, depth=1)).node_rows()[0][10]


def test_edges(spark):
    one = spark.createDataFrame([(1.0, 1)], "x double, label int")
    root = fit(one, ["x"], "label", params(trees=1)).node_rows()[0]
    p = 1 / (1 + math.exp(-0.5))
    assert root[10] and root[7] == pytest.approx((1 - p) / (p * (1 - p) + 1))
    flat = spark.createDataFrame([(1.0, 1), (1.0, 0), (1.0, 1)], "x double, label int")
    assert len(fit(flat, ["x"], "label", params(trees=1)).node_rows()) == 1
    # Equal gains: the smaller feature, then the smaller value.
    twins = spark.createDataFrame([(1.0, 1.0, 0), (2.0, 2.0, 1), (3.0, 3.0, 0)], "a double, b double, label int")
    assert fit(twins, ["a", "b"], "label", params(trees=1, depth=1)).node_rows()[0][4:6] == (0, 1.5)
    holes = spark.createDataFrame([(1.0, 1), (None, 0)], "x double, label int")
    with pytest.raises(ValueError, match="missing"):
        fit(holes, ["x"], "label", params())
    with pytest.raises(ValueError, match="no rows"):
        fit(one.limit(0), ["x"], "label", params())
    empty = BoostedModel(params(trees=0), ("x",))
    assert empty.predict_proba(one).first()["probability"] == 0.0
    assert fit(one, ["x"], "label", params(trees=0)).trees == []


def test_log_odds_start_and_row_sample(spark, folder):
    orders = views.ord_xy(spark, folder)
    model = fit(orders, views.ORD_FEATURES, "label", params(trees=1, depth=1, train_margin=None, subsample_rows=0.5), "row_id")
    assert model.trees[0].n[0] == 750
    with pytest.raises(ValueError, match="row_id"):
        fit(orders, views.ORD_FEATURES, "label", params(subsample_rows=0.5))


def test_column_sample(sample):
    df, _, _ = sample
    assert sample_columns(4, 1.0, 0, 0) == (0, 1, 2, 3)
    picks = {sample_columns(8, 0.4, 1, t) for t in range(20)}
    assert all(len(p) == 3 for p in picks) and len(picks) > 1
    model = fit(df, LI, "label", params(subsample_cols=0.5))
    for t in model.trees:
        assert t.used_features() <= set(t.features) and len(t.features) == 2


def test_save_and_load(spark, sample, tmp_path):
    df, _, _ = sample
    model = fit(df, LI, "label", params())
    model.save(spark, str(tmp_path / "m"))
    back = BoostedModel.load(spark, str(tmp_path / "m"))
    assert back.params == model.params and back.node_rows() == model.node_rows()
    a = model.predict_proba(df).agg(F.sum("probability")).first()[0]
    assert back.predict_proba(df).agg(F.sum("probability")).first()[0] == a


def test_scoring_needs_no_shuffle_and_reads_only_used_columns(spark, folder, sample):
    df, _, _ = sample
    model = fit(df, LI, "label", params(subsample_cols=0.5, trees=1))
    scored = model.predict_proba(views.li_xy(spark, folder)).select("probability")
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    read = plan[plan.index("ReadSchema") :]
    for i, name in enumerate(LI):
        assert (name in read) == (i in model.trees[0].used_features())


def test_the_usual_configuration(spark, folder):
    """Depth 8, ten trees, rate 0.1, no regularization, against the plain model on the customers."""
    rows = views.table(spark, folder, "customer").select(
        F.col("c_custkey").cast("double").alias("a"), (F.col("c_custkey") * 7919 % 31).cast("double").alias("b"),
        F.col("c_acctbal").alias("c"), (F.col("c_mktsegment") < "C").cast("int").alias("label"),
    )
    data = rows.toPandas()
    names = ["a", "b", "c"]
    config = dict(trees=10, depth=8, learning_rate=0.1, reg_lambda=0.0, gamma=0.0)
    model = fit(rows, names, "label", params(**config))
    expected, losses = brute.fit(data[names].to_numpy(float), data["label"].to_numpy(), 10, 8, 0.1, 0.0, 0.0)
    assert model.losses == pytest.approx(losses, abs=1e-6)
    assert [len(nodes_of(model, t)) for t in range(10)] == [len(t) for t in expected]


def test_levels_by_value_and_by_blocks_agree(sample, monkeypatch):
    df, _, _ = sample
    by_value = fit(df, LI, "label", params())
    monkeypatch.setattr(splits, "BY_VALUE_ROWS", 0)
    assert fit(df, LI, "label", params()).node_rows() == by_value.node_rows()
    monkeypatch.setattr(bins, "BLOCK_QUANTILES", 4)
    monkeypatch.setattr(splits, "SUB_QUANTILES", 3)
    monkeypatch.setattr(splits.exact_best, "__defaults__", (8, 3))
    assert fit(df, LI, "label", params()).node_rows() == by_value.node_rows()


def test_plans_of_deep_levels_stay_small(sample, monkeypatch):
    df, _, _ = sample
    sizes = []

    def seen(rows, *more):
        sizes.append(len(rows._jdf.queryExecution().optimizedPlan().toString()))
        return whole(rows, *more)

    whole = tree.best_splits
    monkeypatch.setattr(tree, "best_splits", seen)
    fit(df, LI, "label", params(trees=1, depth=8, reg_lambda=0.0))
    assert len(sizes) == 8 and max(sizes) < 100_000


def test_fits_that_share_rows_equal_single_ones(sample):
    df, _, _ = sample
    configs = [params(), params(gamma=2.0, min_gain=0.0)]
    shared = fit_each(df, LI, "label", configs)
    assert [m.node_rows() for m in shared] == [fit(df, LI, "label", p).node_rows() for p in configs]
    with pytest.raises(ValueError, match="share"):
        fit_each(df, LI, "label", [params(), params(method="histogram")])


@pytest.mark.parametrize("rules", [{"reg_lambda": 0.0}, {"gamma": 0.5, "min_gain": 0.0}, {"min_leaf": 9, "min_child_weight": 3.0}])
def test_subtrees_grown_in_tasks_equal_levels(spark, sample, monkeypatch, rules):
    """To the last bit, with ties, copies of a feature and NaN, wherever the levels end and the subtrees begin."""
    from copse.operators import subtree

    df, _, _ = sample
    nan = F.when(F.col("l_tax") > 0.06, float("nan")).otherwise(F.col("l_tax"))
    df = df.withColumn("again", F.col("l_quantity")).withColumn("holes", nan)
    names, config = [*LI, "again", "holes"], params(trees=2, depth=6, **rules)
    found = []
    for numbers in (0, 240 * 7 * 6 // 4, 240 * 7 * 6):  # rows, features and one more, arrays of a task
        monkeypatch.setattr(subtree, "TASK_NUMBERS", numbers)
        found.append(repr(fit(df, names, "label", config).node_rows()))
    assert found[0] == found[1] == found[2]


def test_rows_that_fit_a_task_are_not_searched_by_level(sample, monkeypatch):
    df, x, y = sample

    def refused(*_):
        raise AssertionError("searched by level")

    monkeypatch.setattr(splits, "value_best", refused)
    monkeypatch.setattr(splits, "exact_best", refused)
    expected, _ = brute.fit(x, y, 2, 8, 0.3, 0.0, 0.0)
    check_same(fit(df, LI, "label", params(depth=8, reg_lambda=0.0)), expected)
