"""Files in and out, and streams."""

import pytest
from pyspark.sql import functions as F

from copse.functions.scalars import MISSING_VALUE
from copse.operators.metrics import confusion, metrics
from copse.params import BoostParams
from copse.plans import catalog, views
from copse.plans.evaluate import train_and_evaluate
from copse.session import cut_to, new_folder, remove_folder, scratch_root
from copse.sources import sinks, tables
from copse.streaming.score import score_stream


def write(path, text):
    path.write_text(text)
    return str(path)


def test_missing_tokens(spark, tmp_path):
    path = write(tmp_path / "m.csv", "1,,NaN\nNA,null,2.5\nnan,-3,1e2\n")
    rows = [tuple(r) for r in tables.read_matrix_with_missing(spark, path, ["a", "b", "c"]).collect()]
    assert rows[0] == (1.0, MISSING_VALUE, MISSING_VALUE)
    assert rows[1] == (MISSING_VALUE, MISSING_VALUE, 2.5)
    assert rows[2][0] != rows[2][0] and rows[2][1:] == (-3.0, 100.0)
    short = write(tmp_path / "s.csv", "1,2,\n")
    assert tuple(tables.read_matrix_with_missing(spark, short, ["a", "b", "c"]).first()) == (1.0, 2.0, MISSING_VALUE)
    bad = write(tmp_path / "b.csv", "1,N/A\n")
    with pytest.raises(Exception, match="N/A"):
        tables.read_matrix_with_missing(spark, bad, ["a", "b"]).collect()


def test_strict_numbers_and_missing_files(spark, tmp_path):
    bad = write(tmp_path / "b.csv", "1,2\n3,x\n")
    with pytest.raises(Exception):
        tables.read_matrix(spark, bad, ["a", "b"]).collect()
    with pytest.raises(Exception):
        tables.read_matrix(spark, str(tmp_path / "none.csv"), ["a"]).collect()


def test_labels(spark, tmp_path):
    path = write(tmp_path / "l.csv", "1\n0.9\n-1.7\n")
    assert [r[0] for r in tables.read_labels(spark, path).collect()] == [1, 0, -1]
    path = write(tmp_path / "n.csv", "1\nNA\n\nnull\n")
    assert [r[0] for r in tables.read_labels(spark, path, missing=True).collect()] == [1, 0, None, 0]


def test_header_table(spark, tmp_path):
    path = write(tmp_path / "t.csv", "a,b\n1,x\n2,y\n")
    assert tables.read_table(spark, path).dtypes == [("a", "int"), ("b", "string")]
    assert tables.read_table(spark, path, "a double, b string").first()["a"] == 1.0


def test_line_index_over_many_splits(spark, tmp_path):
    for part in range(3):
        write(tmp_path / f"p{part}.csv", "".join(f"{part * 1000 + i}\n" for i in range(1000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        indexed = tables.with_line_index(tables.read_matrix(spark, str(tmp_path), ["v"]), "at")
        rows = indexed.collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(rows) == 3000 and all(r["at"] == r["v"] for r in rows)


def test_zip_needs_equal_lengths(spark, tmp_path):
    a = write(tmp_path / "a.csv", "1,2\n3,4\n5,6\n")
    b = write(tmp_path / "b.csv", "1\n0\n")
    with pytest.raises(ValueError, match="3 feature rows but 2 labels"):
        tables.load_training(spark, a, b, ["x", "y"])
    c = write(tmp_path / "c.csv", "1\n0\n1\n")
    rows = tables.load_training(spark, a, c, ["x", "y"]).orderBy("row_id").collect()
    assert [tuple(r) for r in rows] == [(0, 1.0, 2.0, 1), (1, 3.0, 4.0, 0), (2, 5.0, 6.0, 1)]


def test_sinks(spark, tmp_path, folder):
    log = spark.createDataFrame([(0, 1.5, 10.0, 10.0), (1, 1.25, 5.0, 15.0)], "tree_id int, loss double, elapsed_ms double, total_ms double")
    sinks.write_losses(log, str(tmp_path / "loss"))
    assert [r[0] for r in spark.read.text(str(tmp_path / "loss")).collect()] == ["0,1.5", "1,1.25"]
    sinks.write_times(log, str(tmp_path / "time"))
    assert [r[0] for r in spark.read.text(str(tmp_path / "time")).collect()] == ["tree_id,elapsed_ms", "0,10.0", "1,15.0"]
    sinks.write_loss_comparison(log, log, ("by_split", "by_feature"), str(tmp_path / "both"))
    assert spark.read.csv(str(tmp_path / "both"), header=True).columns == ["tree_id", "by_split", "by_feature"]
    df = spark.createDataFrame([(5, 1.5, 1)], "id long, x double, label int")
    sinks.write_training(df, str(tmp_path / "train"), ["x"], "label", "id")
    assert spark.read.text(str(tmp_path / "train/features")).first()[0] == "5,1.5"
    assert spark.read.text(str(tmp_path / "train/labels")).first()[0] == "5,1"


def test_scratch_tables(spark):
    path = new_folder(spark, "t")
    assert cut_to(spark.range(3), path).count() == 3
    remove_folder(spark, path)
    with pytest.raises(Exception):
        spark.read.parquet(path)
    with pytest.raises(ValueError):
        remove_folder(spark, scratch_root(spark))


def test_stream_scores_files_as_they_come_and_after_a_restart(spark, folder, tmp_path):
    model = catalog.small_model()
    rows = views.li_xy(spark, folder)
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    first, second = rows.randomSplit([0.5, 0.5], 1)
    first.write.parquet(source)
    for batch in (None, second):
        if batch is not None:
            batch.write.mode("append").parquet(source)
        stream = spark.readStream.schema(rows.schema).parquet(source)
        score_stream(stream, model, out, state, once=True).awaitTermination()
    got, want = spark.read.parquet(out), model.predict_proba(rows)
    assert got.count() == want.count()
    assert metrics(confusion(got)).collect() == metrics(confusion(want)).collect()
    assert got.agg(F.round(F.sum("probability"), 6)).first() == want.agg(F.round(F.sum("probability"), 6)).first()


def test_whole_run_from_files(spark, tmp_path):
    lines = [(i % 7, i % 11, int((i % 7) + (i % 3) > 5)) for i in range(300)]
    data = write(tmp_path / "x.csv", "".join(f"{a},{b if i % 50 else 'NA'}\n" for i, (a, b, _) in enumerate(lines)))
    labels = write(tmp_path / "y.csv", "".join(f"{y}\n" for *_, y in lines))
    params = BoostParams(trees=2, depth=3, gamma=0.0, subsample_cols=1.0)
    out = str(tmp_path / "out")
    for _ in range(2):
        done = train_and_evaluate(
            spark, data, labels, ["a", "b"], params, out, missing=True, compare=(params, params.with_choice(3))
        )
    row = done.measured.first()
    assert row["n"] == 60 and done.model.trees[0].n[0] == 240
    assert spark.read.parquet(f"{out}/runs").count() == 2
    both = spark.read.csv(f"{out}/loss_by_strategy", header=True, inferSchema=True).collect()
    assert [r["first"] for r in both] == pytest.approx(done.model.losses)
    assert spark.read.csv(f"{out}/loss_per_tree").count() == 2
