import corpus_pipeline
import messy
import pytest

import test_jaccard
import test_packing
import test_quality
from copse.llm import catalog, langid, packing


def test_stages_take_effect_on_whole_tables(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, now = docs.columns, docs
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, now, folder)
        out.write.parquet(str(tmp_path / name))
        before, now = now.collect(), spark.read.parquet(str(tmp_path / name))
        kept = {r.doc_id for r in now.collect()}
        if i < 3:
            assert now.columns == columns
        if name == "language_id":
            assert kept == {r.doc_id for r in before if any(c.isalpha() for c in r.text or "")}
        if name == "quality_rules":
            assert kept == {key[0] for key in test_quality.brute(before) if key[-1]}
        if name == "ngram_jaccard_join":
            assert kept == {key[2] for key in test_jaccard.brute([(r.doc_id, r.text) for r in before])}
        if name == "packing":
            assert kept == {r.doc_id for r in before}
            test_packing.check_places(now.collect())
    run = corpus_pipeline.run(spark, folder)
    assert messy.counted(run, test_packing.COLUMNS) == messy.counted(now, test_packing.COLUMNS)


@pytest.mark.parametrize("make", [messy.frame, messy.empty])
def test_messy_tables(spark, make, tmp_path):
    df = make(spark)
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, df, "")
        assert i == 3 or out.columns == messy.frame(spark).columns
        out.write.parquet(str(tmp_path / name))
        df = spark.read.parquet(str(tmp_path / name))


def test_queries_are_registered():
    import __spark_entry__ as entry

    names = entry.queries()
    assert set(catalog.QUERIES) | {"pipeline"} <= set(names) and {n.split("_")[0] for n in catalog.QUERIES} == {f"op{i}" for i in range(1, 14)}
    assert set(catalog.SQL) <= set(catalog.QUERIES)
    assert langid.UNKNOWN == "und" and packing.WINDOW == 2048
