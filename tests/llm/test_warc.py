import base64
import hashlib

import messy
import pandas as pd
import pytest
from pyspark.sql import functions as F

from copse.llm import catalog, warc

HTML = [None, "", "<p>a</p>", "<p>a</p>", "<p>b</p>", "<p>a</p>", "é😀\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\n", "x" * 300_000, "\r\n\r\n", "", "<p>b</p>", "\x00\x1f"]


def pages(spark, partitions=4):
    rows = [(i, None if i % 4 == 1 else f"http://h/{i}\r\nX: y" if i == 2 else f"http://h/{i}", h, "clash", 1) for i, h in enumerate(HTML)]
    rows += [rows[4], rows[10], rows[10], (None, "http://none/", "only here", "", 1), (None, None, "<p>a</p>", "", 1)]
    return spark.createDataFrame(rows, "page_id long, url string, html string, payload_digest string, refers_to long").repartition(partitions)


def brute(rows):
    out, groups = {}, {}
    for r in rows:
        payload = (r.html or "").encode()
        groups.setdefault(payload, []).append(r.page_id)
    for payload, ids in groups.items():
        best = max((i for i in ids if i is not None), default=None)
        for i in ids:
            digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
            key = (i, len(payload), digest, "response", None) if i == best else (i, len(payload), digest, "revisit", best)
            out[key] = out.get(key, 0) + 1
    return out


COLUMNS = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]


@pytest.mark.parametrize("partitions", [1, 5])
def test_roundtrip_equals_brute_force(spark, partitions):
    df = pages(spark, partitions)
    assert messy.counted(warc.roundtrip(spark, df), COLUMNS) == brute(df.collect())


def test_hot_payload(spark, monkeypatch):
    import copse.session as session

    monkeypatch.setattr(session.skew_join, "__defaults__", (None, 10, "inner"))
    df = spark.range(200).select(F.col("id").alias("page_id"), F.lit("u").alias("url"), F.when(F.col("id") % 3 == 0, F.lit("")).otherwise(F.col("id").cast("string")).alias("html"))
    assert messy.counted(warc.roundtrip(spark, df), COLUMNS) == brute(df.collect())


def test_files_are_archives(spark, tmp_path):
    path = str(tmp_path / "a")
    warc.write_archives(pages(spark), path)
    records = []
    for file in (tmp_path / "a").glob("*.gz"):
        records += list(warc.parse_records(file.read_bytes()))
    assert len(records) == pages(spark).count()
    by_id = {}
    for head, block in records:
        assert len(block) == int(head["content-length"]) and "\n" not in head["warc-target-uri"]
        http, _, payload = block.partition(b"\r\n\r\n")
        assert http.startswith(b"HTTP/1.1 200 OK")
        if head["warc-type"] == "response":
            assert base64.b32encode(hashlib.sha1(payload).digest()).decode() == head["warc-payload-digest"].removeprefix("sha1:")
            by_id[head["warc-record-id"]] = head["warc-payload-digest"]
        else:
            assert payload == b"" and "warc-profile" in head
    assert all(by_id[h["warc-refers-to"]] == h["warc-payload-digest"] for h, _ in records if h["warc-type"] == "revisit")
    html = {r.page_id: r.html for r in warc.read_archives(spark, path).filter("record_type = 'response'").collect()}
    assert html[7] == HTML[7] and html[6] == HTML[6]


def test_broken_archive():
    with pytest.raises(ValueError):
        list(warc.parse_records(b"no archive"))


def test_empty_and_query(spark, folder):
    assert warc.roundtrip(spark, pages(spark).limit(0)).count() == 0
    want = brute(spark.read.parquet(f"{folder}/pages.parquet").collect())
    assert messy.counted(catalog.op4_warc(spark, folder), COLUMNS) == want


def test_large_pages_lie_in_small_files_and_frames(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "FILE_BYTES", 50_000)
    monkeypatch.setattr(warc, "FRAME_BYTES", 30_000)
    df = spark.createDataFrame([(i, f"u{i}", f"{i}-" + "x" * (20_000 + i)) for i in range(40)], "page_id long, url string, html string").coalesce(1)
    warc.write_archives(df, str(tmp_path / "a"))
    files = list((tmp_path / "a").glob("*.gz"))
    assert len(files) >= 20
    got = {r.page_id: r.html for r in warc.read_archives(spark, str(tmp_path / "a")).collect()}
    assert got == {r.page_id: r.html for r in df.collect()}
    frames = list(warc._read(iter([pd.DataFrame({"content": [f.read_bytes() for f in files]})])))
    assert sum(map(len, frames)) == 40 and max(map(len, frames)) <= 2
