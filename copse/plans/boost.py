"""Boosting: fit an ensemble, score rows with it, store it as a table."""

from __future__ import annotations

import json
import time
from collections.abc import Sequence
from dataclasses import asdict, dataclass, field, replace

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import scalars
from ..operators import bins, scoring, splits, subtree
from ..operators.rank import row_sample
from ..operators.route import ROOT, Tree, descend, leaf_output
from ..operators.tree import grow, sample_columns
from ..params import BoostParams
from ..session import cut_to, new_folder, remove_folder

NODE_SCHEMA = (
    "tree_id int, node_id bigint, depth int, n_rows bigint, var_idx int, split double, "
    "gain double, val double, left bigint, right bigint, is_leaf boolean"
)


@dataclass
class BoostedModel:
    params: BoostParams
    features: tuple[str, ...]
    trees: list[Tree] = field(default_factory=list)
    losses: list[float | None] = field(default_factory=list)
    elapsed_ms: list[float] = field(default_factory=list)

    # --- scoring: one projection, for batch and streaming frames alike ---------------

    def margin(self) -> Column:
        if not self.trees:
            return F.lit(float(self.params.score_margin))
        return scoring.margin(self.trees, self.features, float(self.params.score_margin), float(self.params.learning_rate))

    def probability(self) -> Column:
        """Probability of class 1; 0.0 for a model without trees."""
        return scalars.sigmoid(self.margin()) if self.trees else F.lit(0.0)

    def predict_proba(self, df: DataFrame, column: str = "probability") -> DataFrame:
        return df.withColumn(column, self.probability())

    def predict_leaf(self, df: DataFrame, tree_id: int, leaf: str = "leaf", value: str = "leaf_value") -> DataFrame:
        """Leaf number and output of one tree."""
        found = df.withColumn("_leaf", scoring.leaf(self.trees[tree_id], self.features))
        return found.withColumns({leaf: F.col("_leaf.leaf"), value: scoring.or_nan(F.col("_leaf.value"))}).drop("_leaf")

    # --- tables ----------------------------------------------------------------------

    def node_rows(self) -> list[tuple]:
        return [
            (
                tree_id, t.heap[i], t.depth[i], t.n[i],
                None if t.is_leaf(i) else t.feature[i],
                None if t.is_leaf(i) else t.split[i],
                t.gain[i], t.value[i],
                None if t.is_leaf(i) else 2 * t.heap[i],
                None if t.is_leaf(i) else 2 * t.heap[i] + 1,
                t.is_leaf(i),
            )
            for tree_id, t in enumerate(self.trees)
            for i in range(len(t.heap))
        ]

    def nodes(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.node_rows(), NODE_SCHEMA)

    def training_log(self, spark: SparkSession) -> DataFrame:
        """Loss, build time and running build time per tree."""
        rows = [(i, loss, ms) for i, (loss, ms) in enumerate(zip(self.losses, self.elapsed_ms))]
        # One row per tree: a window over the whole table is small by nature.
        so_far = Window.orderBy("tree_id").rowsBetween(Window.unboundedPreceding, 0)
        return spark.createDataFrame(rows, "tree_id int, loss double, elapsed_ms double").withColumn(
            "total_ms", F.sum("elapsed_ms").over(so_far)
        )

    def save(self, spark: SparkSession, path: str) -> None:
        self.nodes(spark).write.mode("overwrite").parquet(f"{path}/nodes")
        head = json.dumps(
            {
                "params": asdict(self.params), "features": self.features,
                "losses": self.losses, "elapsed_ms": self.elapsed_ms, "trees": len(self.trees),
                "sampled": [t.features for t in self.trees],
            }
        )
        spark.createDataFrame([(head,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/head")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "BoostedModel":
        head = json.loads(spark.read.text(f"{path}/head").first()[0])
        trees = [Tree(features=tuple(f)) for f in head["sampled"]]
        stored = spark.read.parquet(f"{path}/nodes").orderBy("tree_id", "node_id").collect()
        place: dict[tuple[int, int], int] = {}
        for r in stored:
            t = trees[r.tree_id]
            place[r.tree_id, r.node_id] = at = t.add(r.node_id, r.depth, r.n_rows, 0.0, 0.0)
            t.value[at], t.gain[at] = r.val, r.gain
            if not r.is_leaf:
                t.feature[at], t.split[at] = r.var_idx, r.split
        for r in stored:
            if not r.is_leaf:
                trees[r.tree_id].left[place[r.tree_id, r.node_id]] = place[r.tree_id, r.left]
        return cls(
            BoostParams(**head["params"]), tuple(head["features"]), trees, head["losses"], head["elapsed_ms"]
        )


def feature_columns(df: DataFrame, array_column: str, size: int) -> tuple[DataFrame, list[str]]:
    """Spread an array column of known size into one column per feature."""
    names = [f"{array_column}_{i}" for i in range(size)]
    return df.withColumns({n: F.get(array_column, F.lit(i)).cast("double") for i, n in enumerate(names)}), names


@dataclass
class Training:
    """Rows ``x<i>, [b<i>,] label`` ready for a fit, written to a scratch folder, and their cuts."""

    rows: DataFrame
    cuts: list[list[float]] | None
    folder: str | None
    """Where the rows are; ``None`` if another one owns them."""
    size: int | None = None

    def keep(self, rows: DataFrame) -> None:
        """Take ``rows``, computed from the present ones, in their place."""
        spark, before = rows.sparkSession, self.folder
        self.folder = new_folder(spark, "training")
        self.rows = cut_to(rows, self.folder)
        if before:
            remove_folder(spark, before)

    def lent(self) -> "Training":
        """The same rows for one of several fits, which leaves them where they are."""
        return replace(self, folder=None)

    def release(self) -> None:
        if self.folder:
            remove_folder(self.rows.sparkSession, self.folder)


def prepare(df: DataFrame, features: Sequence[str], label: str | Column, params: BoostParams) -> Training:
    """Check the rows, find the cuts of the buckets, and write what a fit reads over and over.

    The columns that a fit needs are written once; that table is checked and searched for its quantiles, which takes a few passes, and is
    then rewritten with bucket numbers, if the method has any.
    """
    label = F.col(label) if isinstance(label, str) else label
    names = [f"x{i}" for i in range(len(features))]
    buckets = [f"b{i}" for i in range(len(features))]
    plain = df.select(
        *[scalars.one_zero(F.col(c).cast("double")).alias(x) for c, x in zip(features, names)],
        label.cast("int").alias("label"),
    )
    path = new_folder(df.sparkSession, "training")
    data = Training(cut_to(plain, path), None, path)
    try:
        data.keep(_started(data, names, buckets, params))
    except BaseException:
        data.release()
        raise
    return data


def _started(data: Training, names: list[str], buckets: list[str], params: BoostParams) -> DataFrame:
    """The rows with bucket numbers, if the method has any, and with the margin, gradient and hessian they start from."""
    base = data.rows
    missing = F.greatest(*[F.col(c).isNull().cast("int") for c in ("label", *names)], F.lit(0))
    one = F.count_if(F.col("label") == 1)
    checked = base.agg(
        F.count("*").alias("n"), F.sum(missing).alias("bad"), scalars.log_odds(one, F.count("*") - one).alias("log_odds")
    ).first()
    if not checked["n"]:
        raise ValueError("no rows to fit on")
    if checked["bad"]:
        raise ValueError(f"{checked['bad']} rows have a missing label or feature; impute or drop them first")
    start = checked["log_odds"] if params.train_margin is None else params.train_margin
    if start is None:
        raise ValueError("the log-odds of one class alone are undefined")
    data.size = checked["n"]
    if params.method == "exact" and data.size > splits.BY_VALUE_ROWS and not subtree.fits_task(data.size, len(names)):
        data.cuts = bins.quantile_cuts(base, names, bins.quantile_points(bins.BLOCK_QUANTILES), bins.BLOCK_ROUNDS)
        base = bins.with_blocks(base, names, buckets, data.cuts)
    elif params.method == "quantile":
        data.cuts = bins.quantile_cuts(base, names, bins.eps_points(params.eps))
        base = bins.with_right_closed_bins(base, names, buckets, data.cuts)
    return _with_gradients(base.withColumn("margin", F.lit(float(start))))


def _with_gradients(rows: DataFrame) -> DataFrame:
    return rows.withColumns(
        {"g": scalars.gradient(F.col("margin"), F.col("label")), "h": scalars.hessian(F.col("margin"))}
    )


def fit(
    df: DataFrame,
    features: Sequence[str],
    label: str | Column,
    params: BoostParams = BoostParams(),
    row_id: str | None = None,
) -> BoostedModel:
    """Fit ``params.trees`` trees one after the other.

    After each tree the rows are rewritten with their new margin, gradient and hessian, which cuts the lineage; the
    tree's loss comes out of the same pass. Once an output is undefined (a leaf whose denominator is zero), no later tree has a split.
    """
    if params.subsample_rows is not None:
        if row_id is None:
            raise ValueError("subsample_rows needs row_id, the name of a unique column")
        df = row_sample(df, row_id, params.subsample_rows, params.seed)
    model = BoostedModel(params, tuple(features))
    if params.trees == 0:
        return model
    data = prepare(df, features, label, params)
    try:
        _boost(model, data, len(features), params)
    finally:
        data.release()
    return model


def fit_each(df: DataFrame, features: Sequence[str], label: str | Column, configs: Sequence[BoostParams]) -> list[BoostedModel]:
    """A model for each of ``configs``, on rows that are prepared once; they may differ in what preparing does not look at."""
    looked_at = {(p.method, p.eps, p.train_margin, p.subsample_rows) for p in configs}
    if len(looked_at) > 1 or any(p.subsample_rows is not None for p in configs):
        raise ValueError("fits that share their rows need one method, eps and start, and all rows")
    models = [BoostedModel(p, tuple(features)) for p in configs]
    if all(p.trees == 0 for p in configs):
        return models
    data = prepare(df, features, label, configs[0])
    try:
        for model in models:
            own = data.lent()
            try:
                _boost(model, own, len(features), model.params)
            finally:
                own.release()
    finally:
        data.release()
    return models


def _boost(model: BoostedModel, data: Training, total: int, params: BoostParams) -> None:
    for tree_id in range(params.trees):
        began = time.monotonic()
        chosen = sample_columns(total, params.subsample_cols, params.seed, tree_id)
        if params.weighted and tree_id:
            # All rows start with one margin and so with one weight; from the second tree on weights differ.
            names, buckets = ([f"{c}{i}" for i in range(total)] for c in "xb")
            data.cuts = bins.quantile_cuts(data.rows, names, bins.eps_points(params.eps), weight=bins.whole_weight(F.col("h")))
            data.keep(bins.with_right_closed_bins(data.rows.drop(*buckets), names, buckets, data.cuts))
        if all(None not in (t.value[i] for i in range(len(t.heap)) if t.is_leaf(i)) for t in model.trees):
            tree = grow(data.rows, total, chosen, params, data.cuts, data.size)
        else:
            tree = Tree(features=chosen)
            tree.add(ROOT, 0, model.trees[0].n[0], float("nan"), float("nan"))
            tree.value[0] = float("nan")
        model.trees.append(tree)
        moved = descend(data.rows, tree, total).withColumn("_out", leaf_output(tree))
        if tree_id == params.trees - 1:
            loss = moved.agg(rmse(F.col("label"), F.col("_out")).alias("loss")).first()["loss"]
        else:
            seen = Observation("loss")
            moved = moved.observe(seen, rmse(F.col("label"), F.col("_out")).alias("loss"))
            data.keep(_with_gradients(moved.withColumn("margin", F.col("margin") + F.lit(float(params.learning_rate)) * F.col("_out")).drop("node", "_out")))
            loss = seen.get["loss"]
        model.losses.append(loss)
        model.elapsed_ms.append((time.monotonic() - began) * 1000.0)


def rmse(label: Column, output: Column) -> Column:
    """Root mean squared distance between a label and one tree's raw output."""
    return F.sqrt(F.avg((label - output) * (label - output)))
