"""The registered queries: each takes a session and a data folder and reads its whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import scalars
from ..operators import bins, columns, metrics, profile, rank, splits
from ..operators.encode import TargetEncoder
from ..operators.impute import impute
from ..operators.neighbors import knn as nearest
from ..operators.oversample import oversample as balance
from ..operators.route import Tree
from ..operators.tree import best_splits, sample_columns
from ..params import BoostParams
from ..session import cut, new_folder
from ..sources import sinks, tables
from ..streaming.score import score_stream as start_scoring
from . import views
from .boost import BoostedModel, feature_columns, fit, fit_each
from .clean import clean
from .evaluate import train_and_evaluate

Query = Callable[[SparkSession, str], DataFrame]

LI = views.LI_FEATURES
PLAIN = BoostParams(gamma=0.0, subsample_cols=1.0, learning_rate=0.1)


def r6(name: str, column=None, digits: int = 6):
    return F.round(F.col(name) if column is None else column, digits).alias(name)


def split_table(spark: SparkSession, found: dict[int, splits.Split]) -> DataFrame:
    rows = [(s.node, s.f, s.split, s.gain, s.nl, s.nr) for s in found.values()]
    out = spark.createDataFrame(rows, "node int, f int, split double, gain double, nl bigint, nr bigint")
    return out.select("node", "f", r6("split"), r6("gain"), "nl", "nr")


def node_rows(spark: SparkSession, folder: str, node=None, bucket: str | None = None) -> DataFrame:
    """Line items as rows of a node (the root by default) at margin one half.

    ``bucket`` adds the block columns the search over large nodes works with.
    """
    li = views.li_xy(spark, folder)
    rows = li.select(*[F.col(c).alias(f"x{i}") for i, c in enumerate(LI)], "label").withColumn("margin", F.lit(0.5))
    if bucket:
        names, out = [f"x{i}" for i in range(len(LI))], [f"b{i}" for i in range(len(LI))]
        rows = cut(rows, "node-rows")
        cuts = bins.quantile_cuts(rows, names, bins.quantile_points(bins.BLOCK_QUANTILES), bins.BLOCK_ROUNDS)
        rows = bins.with_blocks(rows, names, out, cuts)
    rows = rows.withColumns(
        {"g": scalars.gradient(F.col("margin"), F.col("label")), "h": scalars.hessian(F.col("margin"))}
    )
    return rows.withColumn("node", F.lit(0) if node is None else node)


def halves():
    """Two nodes: small quantities left, large ones right."""
    return F.when(F.col("x0") <= 25.0, 1).otherwise(2)


# --- gradients and split search ---------------------------------------------------------


def grad_hess(spark, folder):
    li = views.table(spark, folder, "lineitem")
    margin = 0.5 + F.col("l_discount") * 10.0 - F.col("l_tax") * 10.0
    label = (F.col("l_returnflag") == "R").cast("int")
    return li.select(
        "l_orderkey", "l_partkey", "l_linenumber",
        r6("g", scalars.gradient(margin, label)), r6("h", scalars.hessian(margin)),
    )


def node_hist(spark, folder):
    hist = splits.node_hist(node_rows(spark, folder, halves()), range(len(LI)))
    return hist.select("node", "f", "v", r6("g"), r6("h"), "n")


def split_candidates(spark, folder):
    hist = splits.node_hist(node_rows(spark, folder), range(len(LI)))
    listed = splits.exact_candidates(hist, PLAIN)
    return listed.select("node", "f", r6("split"), r6("gain"), "nl", "nr")


def split_root(spark, folder):
    rows = node_rows(spark, folder, bucket="blocks")
    return split_table(spark, best_splits(rows, range(len(LI)), PLAIN))


def split_level(spark, folder):
    rows = node_rows(spark, folder, halves(), bucket="blocks")
    return split_table(spark, best_splits(rows, range(len(LI)), PLAIN))


def split_min_gain(spark, folder):
    """Nodes whose best gain passes the threshold."""
    rows = node_rows(spark, folder, halves(), bucket="blocks")
    params = PLAIN.with_choice(3)
    found = best_splits(rows, range(len(LI)), params)
    return split_table(spark, {n: s for n, s in found.items() if s.gain > params.min_gain})


def split_constrained(spark, folder):
    params = BoostParams(gamma=0.0, subsample_cols=1.0, min_leaf=1500, min_child_weight=400.0)
    rows = node_rows(spark, folder, halves(), bucket="blocks")
    return split_table(spark, best_splits(rows, range(len(LI)), params))


def split_histogram(spark, folder):
    params = BoostParams(gamma=0.0, subsample_cols=1.0, method="histogram", num_bins=10)
    return split_table(spark, best_splits(node_rows(spark, folder, halves()), range(len(LI)), params, node_limit=2))


def split_quantile(spark, folder):
    """Every candidate at a quantile, not only the best."""
    params = BoostParams(gamma=0.0, subsample_cols=1.0, method="quantile", eps=0.05)
    rows = node_rows(spark, folder, halves())
    names, out = [f"x{i}" for i in range(len(LI))], [f"b{i}" for i in range(len(LI))]
    cuts = bins.quantile_cuts(rows, names, bins.eps_points(params.eps))
    rows = bins.with_right_closed_bins(rows, names, out, cuts)
    found = splits.cut_candidates(splits.cut_cells(rows, range(len(LI))), cuts, params)
    return found.select("node", "f", r6("split"), r6("gain"), "nl", "nr")


def weighted_cuts(spark, folder):
    """Cuts of line items at equal sums of hessian, for margins that differ from row to row."""
    li = views.table(spark, folder, "lineitem")
    margin = 0.5 + F.col("l_discount") * 40.0 - F.col("l_tax") * 20.0
    rows = cut(li.select(*[F.col(c).alias(f"x{i}") for i, c in enumerate(LI)], scalars.hessian(margin).alias("h")), "weighted-rows")
    names = [f"x{i}" for i in range(len(LI))]
    cuts = bins.quantile_cuts(rows, names, bins.eps_points(0.05), weight=bins.whole_weight(F.col("h")))
    return spark.createDataFrame([(f, v) for f, vs in enumerate(cuts) for v in vs], "f int, cut double")


def split_col_sample(spark, folder):
    chosen = sample_columns(len(LI), 0.5, 7, 0)
    return split_table(spark, best_splits(node_rows(spark, folder, bucket="blocks"), chosen, PLAIN))


def leaf_values(spark, folder):
    sums = node_rows(spark, folder, halves()).groupBy("node").agg(
        F.sum("g").alias("g"), F.sum("h").alias("h"), F.count("*").alias("n")
    )
    return sums.select("node", "n", r6("value", scalars.leaf_value(F.col("g"), F.col("h"), 1.0)))


# --- fitting ----------------------------------------------------------------------------


def _params(**changes) -> BoostParams:
    return BoostParams(**{**dict(trees=2, depth=1, learning_rate=0.1, gamma=0.0, subsample_cols=1.0), **changes})


def _fit(spark, folder, **changes) -> BoostedModel:
    return fit(views.li_xy(spark, folder), LI, "label", _params(**changes))


def tree_nodes(spark, folder):
    nodes = _fit(spark, folder, trees=1, depth=2).nodes(spark)
    return nodes.select(
        "node_id", "depth", "n_rows", "var_idx", r6("split"), r6("gain"), r6("val"), "left", "right", "is_leaf"
    )


def fit_loss(spark, folder):
    """The losses as the loss file has them."""
    path = new_folder(spark, "losses")
    sinks.write_losses(_fit(spark, folder).training_log(spark), path)
    return spark.read.schema("tree_id int, loss double").csv(path).select("tree_id", r6("loss"))


def strategy_loss(spark, folder):
    configs = [_params(depth=2), _params(depth=2, gamma=2.0, min_gain=0.0)]
    plain, positive = fit_each(views.li_xy(spark, folder), LI, "label", configs)
    both = sinks.compare_losses(plain.training_log(spark), positive.training_log(spark), ("plain", "positive"))
    return both.select("tree_id", r6("plain"), r6("positive"))


def training_time(spark, folder):
    """Measured times differ from run to run, so what is shown is whether they add up, in the log and in the file."""
    log = _fit(spark, folder, method="quantile", eps=0.1).training_log(spark)
    path = new_folder(spark, "times")
    sinks.write_times(log, path)
    written = spark.read.schema("tree_id int, written double").csv(path, header=True)
    earlier = log.select((F.col("tree_id") + 1).alias("tree_id"), F.col("total_ms").alias("before"))
    both = log.join(earlier, "tree_id", "left").join(written, "tree_id")
    step = F.col("total_ms") - F.coalesce("before", F.lit(0.0))
    return both.select(
        "tree_id", (F.col("elapsed_ms") >= 0).alias("timed"), (F.abs(step - F.col("elapsed_ms")) < 1e-6).alias("adds_up"),
        (F.abs(F.col("written") - F.col("total_ms")) < 1e-6).alias("written"),
    )


# --- scoring ----------------------------------------------------------------------------


def small_model() -> BoostedModel:
    """Two fixed trees over the line-item features."""
    first, second = Tree(), Tree()
    for tree, heaps in ((first, (1, 2, 3, 4, 5)), (second, (1, 2, 3))):
        for heap in heaps:
            tree.add(heap, heap.bit_length() - 1, 0, 0.0, 0.0)
    first.feature[0], first.split[0], first.left[0] = 1, 30000.0, 1
    first.feature[1], first.split[1], first.left[1] = 0, 12.0, 3
    first.value[2:5] = [0.75, -1.25, 0.5]
    second.feature[0], second.split[0], second.left[0] = 2, 0.05, 1
    second.value[1:3] = [-0.5, 1.5]
    return BoostedModel(BoostParams(learning_rate=0.4), tuple(LI), [first, second])


def _scored(spark, folder) -> DataFrame:
    return small_model().predict_proba(views.li_xy(spark, folder))


def predict_leaf(spark, folder):
    scored = small_model().predict_leaf(views.li_xy(spark, folder), 0)
    return scored.select(*LI, "leaf", r6("leaf_value"))


def predict_proba(spark, folder):
    return _scored(spark, folder).select(*LI, r6("probability"))


def classify(spark, folder):
    p = F.col("probability")
    return _scored(spark, folder).select(
        *LI, scalars.class_of(p).alias("predicted"), scalars.class_by_rounding(p).alias("rounded")
    )


def score_stream(spark, folder):
    """Score the events table as a stream; the result is what the stream wrote."""
    model = BoostedModel(BoostParams(learning_rate=1.0), ("value", "hour"), [_event_tree()])
    schema = views.table(spark, folder, "events").schema
    # A glob, as a streaming source lists a folder: it matches the one name.
    events = spark.readStream.schema(schema).parquet(f"{folder}/events.parque[t]")
    out, state = new_folder(spark, "scored"), new_folder(spark, "scoring-state")
    start_scoring(views.ev_xy(events), model, out, state, once=True).awaitTermination()
    return spark.read.parquet(out).select("event_id", "label", r6("probability"))


def _event_tree() -> Tree:
    tree = Tree()
    for heap in (1, 2, 3):
        tree.add(heap, heap.bit_length() - 1, 0, 0.0, 0.0)
    tree.feature[0], tree.split[0], tree.left[0] = 1, 11.0, 1
    tree.value[1:3] = [-0.25, 0.75]
    return tree


# --- quality ----------------------------------------------------------------------------


def confusion(spark, folder):
    return metrics.confusion(_scored(spark, folder))


def _measured(spark, folder, swapped=False):
    return metrics.metrics(confusion(spark, folder), swapped)


def quality(spark, folder):
    return _measured(spark, folder).select("n", r6("accuracy"), r6("precision"), r6("recall"))


def quality_swapped(spark, folder):
    return _measured(spark, folder, swapped=True).select("n", r6("accuracy"), r6("precision"), r6("recall"))


def quality_text(spark, folder):
    return metrics.metrics_text(_measured(spark, folder))


def log_odds(spark, folder):
    one = F.count_if(F.col("label") == 1)
    return views.li_xy(spark, folder).agg(r6("log_odds", scalars.log_odds(one, F.count("*") - one)))


# --- splits, samples, order --------------------------------------------------------------


def train_test_split(spark, folder):
    return rank.train_test_split(views.ord_xy(spark, folder), "row_id", 0.2, 0).select("row_id", "label", "part")


def row_sample(spark, folder):
    return rank.row_sample(views.ord_xy(spark, folder), "row_id", 0.35, 3).select("row_id", "o_totalprice")


def sort_column(spark, folder, ascending=False):
    """The order is shown as a place, since results are compared unordered: parts of a sorted frame follow each other."""
    orders = views.table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    path = new_folder(spark, "sorted")
    rank.sort_column(orders, "o_totalprice", "o_orderkey", ascending).withColumn("_at", F.monotonically_increasing_id()).write.parquet(path)
    placed = spark.read.parquet(path)
    part = F.shiftright("_at", 33)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    place = F.col("_before") + F.col("_at") - F.shiftleft("_part", 33) + 1
    return placed.withColumn("_part", part).join(sizes, "_part").select("o_orderkey", "o_totalprice", place.alias("rank"))


def sort_column_ascending(spark, folder):
    return sort_column(spark, folder, ascending=True)


def merge_sorted(spark, folder):
    orders = views.table(spark, folder, "orders").select("o_orderkey", F.col("o_totalprice").alias("v"))
    customer = views.table(spark, folder, "customer").select(
        F.col("c_custkey").alias("o_orderkey"), F.col("c_acctbal").alias("v")
    )
    return rank.merge_sorted(orders, customer, "v", "o_orderkey")


def value_rank(spark, folder):
    li = views.table(spark, folder, "orders").select("o_orderkey", F.floor(F.col("o_totalprice") / 1000).alias("v"))
    ranked = rank.value_rank(li, "v", "o_orderkey")
    return ranked.select(
        "o_orderkey", "v", "rank", scalars.largest_power_exponent(F.col("rank")).cast("int").alias("power")
    )


# --- profile and cleaning ------------------------------------------------------------------


def null_rates(spark, folder):
    return profile.null_rates(views.doc_xy(spark, folder)).select("column_name", r6("null_percent"))


def drop_sparse(spark, folder):
    return profile.drop_sparse(views.doc_xy(spark, folder))


def label_distribution(spark, folder):
    shares = profile.label_distribution(views.doc_xy(spark, folder), "label")
    return shares.select("label", "n", r6("percent"), "percent_text")


def _balanced(spark, folder):
    wide, names = feature_columns(views.emb_xy(spark, folder), "embedding", 64)
    return balance(wide, "row_id", "label", names), names


def class_counts(spark, folder):
    after, _ = _balanced(spark, folder)
    return profile.class_counts({"before": views.emb_xy(spark, folder), "after": after}, "label")


def impute_all(spark, folder):
    filled = impute(views.doc_xy(spark, folder), skip=["row_id"])
    return filled.select(
        "row_id", F.col("label").cast("double").alias("label"), F.col("n_chars").cast("double").alias("n_chars"),
        F.col("toxic").cast("double").alias("toxic"), "lang", "source",
    )


def na_sentinel(spark, folder):
    """Numeric columns by way of a CSV with every spelling of a missing field."""
    docs = views.doc_xy(spark, folder)
    token = F.element_at(F.array(*[F.lit(t) for t in ("NaN", "NA", "null")]), (F.col("row_id") % 3 + 1).cast("int"))
    path = new_folder(spark, "missing")
    text = docs.select(
        F.col("row_id").cast("string"),
        F.coalesce(F.col("label").cast("string"), token).alias("label"),
        F.col("toxic").cast("string").alias("toxic"),
        F.col("n_chars").cast("string").alias("n_chars"),
    )
    sinks.write_matrix(text, path, text.columns)
    read = tables.read_matrix_with_missing(spark, path, text.columns)
    return read.select(
        F.col("row_id").cast("long").alias("row_id"),
        (F.col("label") * 1e17).alias("label_e17"), (F.col("toxic") * 1e17).alias("toxic_e17"), "n_chars",
        scalars.label_of(F.col("label")).alias("label_int"),
    )


def csv_roundtrip(spark, folder):
    orders = views.ord_xy(spark, folder).select("row_id", "label", "o_totalprice", "c_acctbal")
    path = new_folder(spark, "csv")
    sinks.write_matrix(orders, path, orders.columns)
    read = tables.read_matrix(spark, path, orders.columns)
    return read.select(
        F.col("row_id").cast("long").alias("row_id"), scalars.label_of(F.col("label")).alias("label"),
        "o_totalprice", "c_acctbal",
    )


def zip_labels(spark, folder):
    """Features and labels written as two files in the same order and paired again by line."""
    pinned = cut(views.ord_xy(spark, folder).select("row_id", "o_totalprice", "label"), "pairs")
    data, labels = new_folder(spark, "features"), new_folder(spark, "labels")
    sinks.write_matrix(pinned, data, ["row_id", "o_totalprice"])
    sinks.write_matrix(pinned, labels, ["label"])
    paired = tables.zip_lines(
        tables.read_matrix(spark, data, ["id", "o_totalprice"]), tables.read_labels(spark, labels), "line"
    )
    return paired.select(F.col("id").cast("long").alias("row_id"), "o_totalprice", "label")


def read_table(spark, folder):
    """A table with a header, by an explicit schema."""
    customer = views.table(spark, folder, "customer")
    path = new_folder(spark, "table")
    customer.write.csv(path, header=True)
    schema = ", ".join(f"{n} {t}" for n, t in customer.dtypes)
    return tables.read_table(spark, path, schema)


def run_log(spark, folder):
    """Append a run to the log and read the log back."""
    path = new_folder(spark, "runs")
    model = small_model()
    record = sinks.run_record(spark, model, _measured(spark, folder), 0.2)
    sinks.append_run(record, path)
    sinks.append_run(record, path)
    log = spark.read.parquet(path)
    return log.select("tn", "fp", "fn", "tp", r6("accuracy"), "arg_learning_rate", "test_size")


def standardize(spark, folder):
    scaled = columns.standardize(views.li_xy(spark, folder), "label")
    return scaled.select("label", *[r6(c) for c in LI])


def one_hot(spark, folder):
    return columns.one_hot(views.ord_xy(spark, folder), "c_mktsegment").drop(*views.ORD_FEATURES, "o_orderpriority")


def one_hot_sparse(spark, folder):
    """Parts of line items as entries of a matrix with a column for each part."""
    li = views.table(spark, folder, "lineitem")
    rows = li.select((F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("row_id"), "l_partkey")
    return columns.one_hot_sparse(rows, "row_id", "l_partkey")


def drop_columns(spark, folder):
    """Drop the first column by position and another by name; list the features apart from the label."""
    docs = columns.drop_by_position(views.doc_xy(spark, folder), 0, 1)
    docs = columns.drop_by_name(docs, "toxic")
    features, label = columns.split_label(docs, "label")
    return docs.select(*features, label)


def drop_null_rows(spark, folder):
    return columns.drop_null_rows(views.doc_xy(spark, folder))


def head_rows(spark, folder):
    return columns.head_rows(views.doc_xy(spark, folder), "row_id", 100)


def target_encode(spark, folder):
    orders = views.ord_xy(spark, folder)
    coded = TargetEncoder.fit(orders, views.ORD_CATEGORIES, "label").transform(orders)
    return coded.select("row_id", *[r6(c) for c in views.ORD_CATEGORIES])


def knn(spark, folder):
    """Five nearest members within each class."""
    near = nearest(views.emb_xy(spark, folder), "row_id", "label", "embedding", 5)
    return near.select("row_id", F.col("cls").alias("label"), "rank", "nn_id", r6("distance"))


def oversample(spark, folder):
    rows, names = _balanced(spark, folder)
    return rows.select("row_id", "label", "synthetic", *[r6(c) for c in names])


def prep_clean(spark, folder):
    """The whole cleaning job over orders: sparse columns, imputing, encoding, balancing."""
    orders = views.ord_xy(spark, folder)
    sparse = F.when(F.col("o_totalprice") > 200000.0, F.col("c_acctbal"))
    table = orders.select(
        "row_id", sparse.alias("sparse"), F.lit("a").alias("first"), "o_orderpriority", "c_mktsegment",
        "o_totalprice", F.when(F.col("c_acctbal") >= 0.0, F.col("c_acctbal")).alias("balance"), "label",
    )
    cleaned = clean(table, "row_id", "label", views.ORD_CATEGORIES, drop_first=1)
    return cleaned.rows.select("row_id", "label", "synthetic", "part", *[r6(c) for c in cleaned.features])


def run_from_files(spark, folder):
    """The run from a feature and a label file to its reports, which are read back: counts, measures and the loss of each tree."""
    ordered = views.ord_xy(spark, folder).orderBy("row_id")  # so lines are numbered by id
    data, labels, out = new_folder(spark, "features"), new_folder(spark, "labels"), new_folder(spark, "reports")
    sinks.write_matrix(ordered, data, views.ORD_FEATURES)
    sinks.write_matrix(ordered, labels, ["label"])
    params = BoostParams(trees=2, depth=2, learning_rate=0.1, gamma=0.0, subsample_cols=1.0)
    train_and_evaluate(spark, data, labels, views.ORD_FEATURES, params, out, 0.2)
    runs = spark.read.parquet(f"{out}/runs").select("tn", "fp", "fn", "tp", "n", r6("accuracy"), r6("precision"), r6("recall"))
    losses = spark.read.schema("tree_id int, loss double").csv(f"{out}/loss_per_tree")
    times = spark.read.schema("tree_id int, ms double").csv(f"{out}/time_per_tree", header=True)
    logged = losses.join(times.filter("ms >= 0"), "tree_id").select(F.lit(1).alias("run"), "tree_id", r6("loss"))
    return logged.join(runs.withColumn("run", F.lit(1)), "run").drop("run")


USUAL = BoostParams(trees=10, depth=8, learning_rate=0.1, reg_lambda=0.0, gamma=0.0, subsample_cols=1.0)


def usual_configuration(spark, folder):
    """Ten trees of depth eight without regularization, from files, a fifth of the rows held out: nodes and loss of each tree, and the measures."""
    ordered = views.ord_xy(spark, folder).orderBy("row_id")
    data, labels, out = new_folder(spark, "features"), new_folder(spark, "labels"), new_folder(spark, "reports")
    sinks.write_matrix(ordered, data, views.ORD_FEATURES)
    sinks.write_matrix(ordered, labels, ["label"])
    done = train_and_evaluate(spark, data, labels, views.ORD_FEATURES, USUAL, out, 0.2)
    sizes = done.model.nodes(spark).groupBy("tree_id").agg(F.count("*").alias("nodes"), F.count_if("is_leaf").alias("leaves"))
    measured = done.measured.select("tn", "fp", "fn", "tp", r6("accuracy"), r6("precision"), r6("recall"))
    losses = done.model.training_log(spark).select("tree_id", r6("loss"))
    return sizes.join(losses, "tree_id").withColumn("run", F.lit(1)).join(measured.withColumn("run", F.lit(1)), "run").drop("run")


def end_to_end(spark, folder):
    """Split, fit, score the test rows, measure."""
    split = rank.train_test_split(views.ord_xy(spark, folder), "row_id", 0.2, 0)
    params = BoostParams(trees=2, depth=2, learning_rate=0.1, gamma=0.0, subsample_cols=1.0)
    model = fit(split.filter("part = 'train'"), views.ORD_FEATURES, "label", params)
    scored = model.predict_proba(split.filter("part = 'test'"))
    measured = metrics.metrics(metrics.confusion(scored))
    return measured.select("tn", "fp", "fn", "tp", "n", r6("accuracy"), r6("precision"), r6("recall"))


QUERIES: dict[str, Query] = {
    "grad_hess": grad_hess,
    "node_hist": node_hist,
    "split_candidates": split_candidates,
    "split_root": split_root,
    "split_level": split_level,
    "split_min_gain": split_min_gain,
    "split_constrained": split_constrained,
    "split_histogram": split_histogram,
    "split_quantile": split_quantile,
    "weighted_cuts": weighted_cuts,
    "split_col_sample": split_col_sample,
    "leaf_values": leaf_values,
    "tree_nodes": tree_nodes,
    "fit_loss": fit_loss,
    "strategy_loss": strategy_loss,
    "training_time": training_time,
    "predict_leaf": predict_leaf,
    "predict_proba": predict_proba,
    "classify": classify,
    "score_stream": score_stream,
    "confusion": confusion,
    "metrics": quality,
    "metrics_swapped": quality_swapped,
    "metrics_text": quality_text,
    "log_odds": log_odds,
    "train_test_split": train_test_split,
    "row_sample": row_sample,
    "sort_column": sort_column,
    "sort_column_ascending": sort_column_ascending,
    "merge_sorted": merge_sorted,
    "value_rank": value_rank,
    "null_rates": null_rates,
    "drop_sparse": drop_sparse,
    "label_distribution": label_distribution,
    "class_counts": class_counts,
    "impute": impute_all,
    "na_sentinel": na_sentinel,
    "csv_roundtrip": csv_roundtrip,
    "zip_labels": zip_labels,
    "read_table": read_table,
    "run_log": run_log,
    "standardize": standardize,
    "one_hot": one_hot,
    "one_hot_sparse": one_hot_sparse,
    "drop_columns": drop_columns,
    "drop_null_rows": drop_null_rows,
    "head_rows": head_rows,
    "target_encode": target_encode,
    "knn": knn,
    "oversample": oversample,
    "prep_clean": prep_clean,
    "run_from_files": run_from_files,
    "end_to_end": end_to_end,
    "usual_configuration": usual_configuration,
}
