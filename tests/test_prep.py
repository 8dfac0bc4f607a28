"""Ranks, imputing, encoding, neighbours, balancing."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from copse.operators import columns, impute, profile, rank
from copse.operators.encode import TargetEncoder
from copse.operators.metrics import confusion, metrics
from copse.operators.neighbors import knn
from copse.operators.oversample import oversample, split_and_oversample
from copse.functions import scalars
from copse.session import skew_join


def test_smallest_is_exact_over_several_rounds(spark):
    df = spark.range(500).withColumnRenamed("id", "row_id")
    order = [r[0] for r in df.orderBy(rank.draw_key("row_id", 9), "row_id").collect()]
    for count in (0, 1, 137, 499, 500):
        for limit in (1, 5, 1000):
            got = df.filter(rank.smallest(df, "row_id", count, 9, limit)).collect()
            assert {r[0] for r in got} == set(order[:count])


def test_split_sizes(spark):
    df = spark.range(103).withColumnRenamed("id", "row_id")
    parts = {r["part"]: r["count"] for r in rank.train_test_split(df, "row_id", 0.2, 1).groupBy("part").count().collect()}
    assert parts == {"train": 83, "test": 20}
    assert rank.row_sample(df, "row_id", 0.5).count() == 52
    assert rank.row_sample(df, "row_id", 1.0).count() == 103


def test_ranked_with_a_hot_value(spark):
    df = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, 7.0).otherwise(F.col("id") % 50).alias("v"))
    got = rank.value_rank(df, "v", "id").select("id", "v", "rank").collect()
    want = sorted(((r["v"], -r["id"]) for r in got))
    assert [(r["v"], -r["id"]) for r in sorted(got, key=lambda r: r["rank"])] == want
    assert sorted(r["rank"] for r in got) == list(range(1, 3001))


def test_sort_and_merge_order(spark):
    a = spark.createDataFrame([(1.0, 1), (3.0, 2)], "v double, i int")
    b = spark.createDataFrame([(1.0, 1), (2.0, 2)], "v double, i int")
    assert [r["v"] for r in rank.sort_column(a, "v", "i", ascending=False).collect()] == [3.0, 1.0]
    assert [(r["v"], r["src"]) for r in rank.merge_sorted(a, b, "v", "i").orderBy("rank").collect()] == [(1.0, 0), (1.0, 1), (2.0, 1), (3.0, 0)]


@pytest.mark.parametrize("partitions", [1, 5])
def test_medians(spark, partitions):
    rng = np.random.default_rng(3)
    data = rng.normal(size=(1001, 2)).round(2)
    hot = [5.0 if i % 3 == 0 else float(i) for i in range(1001)]
    rows = [(float(a), float(b) if i else None, h, None) for i, ((a, b), h) in enumerate(zip(data, hot))]
    df = spark.createDataFrame(rows, "a double, b double, hot double, none double").repartition(partitions)
    got = impute.medians(df, ["a", "b", "hot", "none"])
    assert got["a"] == pytest.approx(np.median(data[:, 0])) and got["b"] == pytest.approx(np.median(data[1:, 1]))
    assert got["hot"] == np.median(hot) and got["none"] is None


def test_impute_rules(spark):
    rows = [(1, 1.0, "b"), (2, float("nan"), "a"), (4, 3.0, "b"), (9, None, "a"), (None, 2.0, None)]
    df = spark.createDataFrame(rows, "i int, x double, s string")
    got = [tuple(r) for r in impute.impute(df).collect()]
    assert got == [(1, 1.0, "b"), (2, 2.0, "a"), (4, 3.0, "b"), (9, 2.0, "a"), (3, 2.0, "a")]


def test_sparse_columns_at_the_threshold(spark):
    df = spark.createDataFrame([(1, None if i < 3 else i, None if i < 2 else i) for i in range(10)], "a int, b int, c int")
    assert profile.drop_sparse(df, 30.0).columns == ["a", "c"]


def test_encoder_unknown_and_missing(spark):
    train = spark.createDataFrame([("a", 1)] * 30 + [("b", 0)] * 10 + [(None, 1)], "c string, y int")
    encoder = TargetEncoder.fit(train, ["c"], "y")
    new = spark.createDataFrame([("a",), ("zz",), (None,)], "c string")
    got = [r["c"] for r in encoder.transform(new).collect()]
    prior = 31 / 41
    weight = 1 / (1 + math.exp(-(30 - 20) / 10))
    assert sorted(got) == pytest.approx(sorted([prior * (1 - weight) + weight, prior, prior]))


def test_sparse_one_hot(spark):
    rows = [(i, None if i % 9 == 0 else f"v{i * 7 % 40:02d}") for i in range(200)]
    df = spark.createDataFrame(rows, "i long, c string")
    place = {v: k for k, v in enumerate(sorted({v for _, v in rows if v}))}
    got = sorted(map(tuple, columns.one_hot_sparse(df, "i", "c").collect()))
    assert got == [(i, place[v], 1) for i, v in rows if v]
    assert columns.one_hot_sparse(df.limit(0), "i", "c").count() == 0


def test_one_hot_refuses_too_many_values(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "c string, i int")
    assert [tuple(r) for r in columns.one_hot(df, "c").orderBy("i").collect()] == [(1, 1, 0), (2, 0, 1), (3, 0, 0)]
    with pytest.raises(ValueError):
        columns.one_hot(df, "c", limit=1)


def test_standardize_constant_column(spark):
    df = spark.createDataFrame([(2.0, 0), (2.0, 1)], "x double, y int")
    assert [r["x"] for r in columns.standardize(df, "y").collect()] == [0.0, 0.0]


def test_metrics_undefined(spark):
    df = spark.createDataFrame([(0, 0.1), (1, 0.2)], "label int, probability double")
    row = metrics(confusion(df)).first()
    assert (row["tn"], row["fp"], row["fn"], row["tp"]) == (1, 0, 1, 0)
    assert row["precision"] is None and row["recall"] == 0.0 and row["accuracy"] == 0.5


def test_scalars(spark):
    df = spark.createDataFrame([(0.5, 1), (0.499999, 7), (0.0, 8)], "p double, n int")
    got = df.select(scalars.class_of(F.col("p")), scalars.class_by_rounding(F.col("p")), scalars.largest_power_exponent(F.col("n")))
    assert [tuple(r) for r in got.collect()] == [(1, 1, 0), (0, 0, 2), (0, 0, 3)]


def plain_knn(ids, x, k):
    out = {}
    for i, a in zip(ids, x):
        d = sorted((math.sqrt(((a - b) ** 2).sum()), j) for j, b in zip(ids, x) if j != i)
        out[i] = [j for _, j in d[:k]]
    return out


@pytest.mark.parametrize("chunk", [7, 40, 2048])
def test_knn_with_a_third_of_copies(spark, chunk):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(150, 3)).round(3)
    x[::3] = [0.25, 0.5, -0.125]
    ids = [int(i) for i in rng.permutation(1000)[:150]]
    df = spark.createDataFrame([(i, 1, *map(float, r)) for i, r in zip(ids, x)], "i long, c int, a double, b double, d double")
    rows = knn(df, "i", "c", ["a", "b", "d"], 5, chunk).collect()
    got = {}
    for r in sorted(rows, key=lambda r: r["rank"]):
        got.setdefault(r["row_id"], []).append(r["nn_id"])
    assert got == plain_knn(ids, x, 5)


def test_knn_small_classes(spark):
    df = spark.createDataFrame([(1, 0, 1.0), (2, 0, 2.0), (3, 1, 5.0)], "i long, c int, x double")
    rows = {(r["row_id"], r["nn_id"]) for r in knn(df, "i", "c", ["x"], 5).collect()}
    assert rows == {(1, 2), (2, 1)}


def test_oversample_balances_and_interpolates(spark):
    rng = np.random.default_rng(1)
    rows = [(i, int(i < 20), float(a), float(b)) for i, (a, b) in enumerate(rng.random((100, 2)))]
    df = spark.createDataFrame(rows, "i long, y int, a double, b double")
    out = oversample(df, "i", "y", ["a", "b"], seed=4)
    again = oversample(df.repartition(5), "i", "y", ["a", "b"], seed=4)
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, again.collect()))
    counts = {r["y"]: r["count"] for r in out.groupBy("y").count().collect()}
    assert counts == {0: 80, 1: 80}
    minority = np.array([r[2:] for r in rows[:20]])
    near = plain_knn(range(20), minority, 5)
    new = [r for r in out.collect() if r["synthetic"]]
    assert len({r["i"] for r in new}) == 60 and all(r["i"] < 0 and r["y"] == 1 for r in new)
    for r in new:
        p = np.array([r["a"], r["b"]])
        gaps = [
            np.linalg.norm(p - minority[i]) + np.linalg.norm(p - minority[j]) - np.linalg.norm(minority[i] - minority[j])
            for i in range(20) for j in near[i]
        ]
        assert min(gaps) < 1e-9


def test_split_and_oversample_keeps_test_rows(spark):
    rows = [(i, int(i % 4 == 0), float(i)) for i in range(200)]
    df = spark.createDataFrame(rows, "i long, y int, a double")
    out = split_and_oversample(df, "i", "y", ["a"]).toPandas()
    test = out[out["part"] == "test"]
    assert len(test) == 40 and not test["synthetic"].any()
    train = out[out["part"] == "train"]
    assert train["y"].value_counts().nunique() == 1


def test_skew_join_equals_plain_join(spark):
    left = spark.range(1000).select("id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 20).alias("k"))
    right = spark.range(15).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    want = sorted(map(tuple, left.join(right, ["k"]).collect()))
    for hot in (10**6, 100, 7):
        assert sorted(map(tuple, skew_join(left, right, ["k"], "id", hot_rows=hot).collect())) == want
    holes = left.withColumn("k", F.nullif("k", F.lit(0)))
    want = sorted(map(repr, holes.join(right, ["k"], "left").collect()))
    assert sorted(map(repr, skew_join(holes, right, ["k"], "id", hot_rows=20, how="left").collect())) == want


def test_encoder_without_broadcast(spark, monkeypatch):
    from copse.operators import encode

    rows = [(i, f"c{i % 5}" if i % 7 else None, i % 2) for i in range(100)]
    df = spark.createDataFrame(rows, "i long, c string, y int")
    encoder = TargetEncoder.fit(df.filter("i < 60 AND i % 5 < 4"), ["c"], "y")
    want = sorted(map(tuple, encoder.transform(df).collect()))
    monkeypatch.setattr(encode, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(encode.skew_join, "__defaults__", (None, 9, "inner"))
    assert sorted(map(tuple, encoder.transform(df).collect())) == want


def test_knn_refuses_missing_features(spark):
    df = spark.createDataFrame([(1, 0, 1.0), (2, 0, None), (3, 0, 2.0)], "i long, c int, x double")
    with pytest.raises(Exception, match="feature is missing"):
        knn(df, "i", "c", ["x"], 1).collect()


@pytest.mark.parametrize("name", ["id", "rank", "x", "z", "u", "i", "cls", "nn_id", "nn_x", "nn_rank", "key"])
def test_oversample_with_any_name_of_the_id(spark, name):
    rows = [(i, 1 if i < 12 else 0, float(i % 7), float(i)) for i in range(60)]
    out = oversample(spark.createDataFrame(rows, f"`{name}` long, y int, a double, b double"), name, "y", ["a", "b"]).toPandas()
    assert out["y"].value_counts().to_dict() == {0: 48, 1: 48} and out[name].is_unique


def test_oversample_leaves_missing_labels_alone(spark):
    rows = [(i, None if i < 60 else int(i >= 90), float(i)) for i in range(100)]
    out = oversample(spark.createDataFrame(rows, "i long, y int, a double"), "i", "y", ["a"]).toPandas()
    assert out["y"].isna().sum() == 60 and out["y"].value_counts().to_dict() == {0.0: 30, 1.0: 30}
    halves = spark.createDataFrame([(1, 0.5, 1.0), (2, 0.0, 2.0), (3, 0.0, 3.0)], "i long, y double, a double")
    with pytest.raises(ValueError, match="whole"):
        oversample(halves, "i", "y", ["a"])


def test_neighbour_search_hands_points_on_in_small_frames():
    import numpy as np
    import pandas as pd

    from copse.operators import neighbors

    rng = np.random.default_rng(0)
    vectors, pivots = rng.random((500, 64)), {0: rng.random((64, 64))}
    points = pd.DataFrame({"cls": 0, "vid": range(500), "ids": [[i] for i in range(500)], "vec": list(vectors)})
    placed = next(neighbors._assign(pivots)(iter([points])))
    between = neighbors._distances(pivots[0], pivots[0])
    reach = {0: (np.full(64, 9.0), np.full(64, np.inf), between)}  # every point matters to every cell
    frames = list(neighbors._send(pivots, reach)(iter([placed.drop(columns="dist")])))
    assert sum(map(len, frames)) == 500 * 64
    assert max(len(f) * 65 for f in frames) <= neighbors.FRAME_NUMBERS
    assert len(pd.concat(frames)[["vid", "cell"]].drop_duplicates()) == 500 * 64


def test_cells_of_few_dimensions_stay_small(spark):
    from copse.operators import neighbors

    points = spark.range(60_000).select(F.lit(1).alias("cls"), F.col("id").alias("vid"), F.array("id").alias("ids"), F.array(F.rand(1), F.rand(2)).alias("vec"))
    pivots, total = neighbors._pivots(points, neighbors.CHUNK)
    assert total == 60_000 and len(pivots[1]) == -(-60_000 // 128)


@pytest.mark.parametrize("asks", [0, 4, 10**6])
def test_knn_by_cells_and_by_blocks(spark, monkeypatch, asks):
    """Points of two classes with copies, some more than travel, some ties, and cells cut into parts; whichever way they are compared."""
    from copse.operators import neighbors

    monkeypatch.setattr(neighbors, "ASKS", asks)
    if not asks:
        monkeypatch.setattr(neighbors, "FAR_SHARE", 0)
        monkeypatch.setattr(neighbors, "RUN_BYTES", 1)
        monkeypatch.setattr(neighbors, "BLOCK_NUMBERS", 64)
        monkeypatch.setattr(neighbors, "FILE_BLOCKS", 2)
    rng = np.random.default_rng(8)
    x = rng.normal(size=(400, 2)).round(1) * [1e5, 1.0]
    x[::9] = [0.0, 0.5]
    ids, cls = rng.permutation(5000)[:400], np.arange(400) % 3 // 2
    df = spark.createDataFrame([(int(i), int(c), *map(float, r)) for i, c, r in zip(ids, cls, x)], "i long, c int, a double, b double")
    got = {}
    for r in sorted(knn(df, "i", "c", ["a", "b"], 5, 50).collect(), key=lambda r: r["rank"]):
        got.setdefault(r["row_id"], []).append(r["nn_id"])
    want = {}
    for c in (0, 1):
        want |= plain_knn(ids[cls == c].tolist(), x[cls == c], 5)
    assert got == want


@pytest.fixture
def scratch(monkeypatch, tmp_path):
    """A scratch folder of the test's own; gives the tables in it."""
    from copse import session

    monkeypatch.setattr(session, "scratch_root", lambda spark: str(tmp_path))
    return lambda: list((tmp_path / "copse").iterdir())


def test_knn_of_many_dimensions_leaves_no_copies_of_points(spark, scratch):
    """With many dimensions every cell matters to every point; none is written more than once for that."""
    rng = np.random.default_rng(2)
    df = spark.createDataFrame([(i, 0, r.tolist()) for i, r in enumerate(rng.normal(size=(600, 32)))], "i long, c int, v array<double>")
    rows = knn(df, "i", "c", "v", 5, 20)
    assert rows.count() == 3000
    # 600 points of 32 numbers are 0.15 MB, and went to 30 cells.
    assert sum(f.stat().st_size for table in scratch() for f in table.rglob("*")) < 150_000
    got = {}
    for r in sorted(rows.collect(), key=lambda r: r["rank"]):
        got.setdefault(r["row_id"], []).append(r["nn_id"])
    assert got == plain_knn(range(600), np.array([r["v"] for r in df.orderBy("i").collect()]), 5)


@pytest.mark.parametrize("offset", [0.0, 1e7])
def test_search_measures_what_rounding_leaves_open(offset):
    """Far from the origin, in clusters and with infinite numbers: the same as all distances ranked."""
    from copse.operators import neighbors

    rng = np.random.default_rng(3)
    for width in (2, 40):
        x = np.repeat(rng.normal(size=(20, width)) * 1e3, 15, axis=0) + rng.normal(size=(300, width)) * 1e-3 + offset
        for points in (x, np.vstack([x, np.full((1, width), np.inf)])):
            n = len(points)
            lists = neighbors._Lists(n, 6)
            for half in (slice(0, 150), slice(150, n)):
                ids = np.arange(n)[half]
                neighbors._search(lists, points, points[half], neighbors._Ids(ids, np.ones(len(ids), dtype=int)))
            with np.errstate(invalid="ignore"):
                d = neighbors._distances(points, points)
            want = np.array([np.lexsort((np.arange(n), r))[:6] for r in d[:300]])
            assert (lists.ids[:300] == want).all()


def test_oversampling_leaves_no_working_tables(spark, scratch):
    rng = np.random.default_rng(6)
    rows = [(i, int(i % 3 == 0), float(a), float(b)) for i, (a, b) in enumerate(rng.random((900, 2)))]
    df = spark.createDataFrame(rows, "i long, y int, a double, b double")
    assert oversample(df, "i", "y", ["a", "b"], seed=4).count() == 1200
    left = {d.name.rsplit("-", 1)[0]: str(d) for d in scratch()}
    assert not left.keys() & {"points", "placed", "sent", "inside", "asked", "blocks", "compared", "neighbors"}
    assert "_key" not in spark.read.parquet(left["ranked"]).columns
