import messy
import numpy as np
import pytest
from pyspark.sql import functions as F

from copse.llm import catalog, sharding


def brute_table(shards, slots):
    """Every shard's whole preference list, then turns."""
    import hashlib

    prefs = {}
    for s in sorted(shards):
        d = hashlib.md5(s.encode()).digest()
        offset, skip = int.from_bytes(d[:8], "big") % slots, int.from_bytes(d[8:], "big") % (slots - 1) + 1
        prefs[s] = iter([(offset + j * skip) % slots for j in range(slots)])
    table = {}
    while len(table) < slots:
        for s in sorted(shards):
            if len(table) < slots:
                table[next(p for p in prefs[s] if p not in table)] = s
    return [table[i] for i in range(slots)]


def test_table_equals_brute_force():
    names = [f"s{i}" for i in (3, 1, 2, 9, 5)]
    assert [names[i] for i in sharding.lookup_table(names, 101)] == brute_table(names, 101)


def test_shares_and_moves():
    names = [f"s{i}" for i in range(20)]
    a = np.array(names)[sharding.lookup_table(names, 5003)]
    b = np.array([*names, "new"])[sharding.lookup_table([*names, "new"], 5003)]
    n = np.unique(a, return_counts=True)[1]
    assert n.max() - n.min() <= 1
    assert 1 / 21 <= (a != b).mean() < 0.15


@pytest.mark.parametrize("bad", [([], 101), (["a", "a"], 101), (["a"], 100), ([str(i) for i in range(102)], 101), (["a"], 1_000_033)])
def test_refused(bad):
    with pytest.raises(ValueError):
        sharding.lookup_table(*bad)


def test_place(spark):
    df = messy.frame(spark).withColumn("shard", F.lit("old"))
    out = sharding.place(df, ["doc_id"], ["x", "y", "z"], 31)
    assert sorted(out.columns) == sorted(df.columns) and out.count() == df.count()
    by_key = out.groupBy("doc_id").agg(F.countDistinct("shard").alias("n")).filter("n > 1").count()
    assert not by_key and not out.filter("shard is null or shard = 'old'").count()
    again = sharding.place(messy.frame(spark, 7), ["doc_id"], ["z", "y", "x"], 31)
    assert messy.counted(out, ["doc_id", "shard"]) == messy.counted(again, ["doc_id", "shard"])
    assert sharding.place(messy.empty(spark), ["doc_id"], ["x"], 31).count() == 0


def test_clashing_names(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", "b", "c", "d"), (2, "e", "f", "g", "h")], "doc_id long, slot string, owner string, row string, _file string")
    out = sharding.place(df, ["doc_id"], ["x"], 31, out="_shard")
    assert out.columns == [*df.columns, "_shard"] and out.drop("_shard").exceptAll(df).count() == 0
    sharding.write_shards(out, str(tmp_path / "out"), "_shard")
    back = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(back.columns) == sorted(out.columns) and back.count() == 2
    assert sharding.place(df, ["doc_id"], ["x"], 31, out="row").columns == ["doc_id", "slot", "owner", "_file", "row"]


def xxh(text):
    import xxhash

    return (xxhash.xxh64_intdigest(text.encode(), seed=42) + 2**63) % 2**64 - 2**63


def test_every_row_lies_where_the_table_says(spark, folder):
    rows = catalog.op1_sharding(spark, folder).collect()
    for shards, column in ((catalog.SHARDS, "shard"), ([*catalog.SHARDS, f"shard-{len(catalog.SHARDS):04d}"], "shard_if_added")):
        table = sharding.lookup_table(shards)
        assert all(r[column] == shards[table[xxh(f"={r.doc_id}") % sharding.SLOTS]] for r in rows)


def test_write(spark, tmp_path):
    df = sharding.place(messy.frame(spark), ["doc_id"], ["x", "y"], 31)
    sharding.write_shards(df, str(tmp_path / "out"), files=2)
    assert spark.read.parquet(str(tmp_path / "out")).count() == df.count()


def test_query(spark, folder):
    out = catalog.op1_sharding(spark, folder).toPandas()
    assert out.doc_id.is_unique and len(out) == spark.read.parquet(f"{folder}/documents.parquet").count()
    moved = out.shard != out.shard_if_added
    assert moved.mean() < 0.1
