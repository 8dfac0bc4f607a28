"""Deduplicated web archives: WARC files in which pages with an equal payload revisit one response.

Headers (page, size, digest of the payload) are shuffled by digest; the largest page of each digest is the original, and
the others become revisit records that point to it. Pages then get fresh headers and are written with Spark's
text writer: a record is its header, a blank line and its block, and the two line ends that close it are the writer's line separator.
Reading takes whole files, walks them record by record by Content-Length, and joins revisit records to their originals.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from copse.session import cut, new_folder, skew_join

DATE = "2000-01-01T00:00:00Z"
"""WARC-Date of records unless given; pages carry no time of their own."""

RECORDS_PER_FILE = 1_000
"""Records in one file at most; a file is read by one task, a few megabytes for usual pages."""

FILE_BYTES = 64_000_000
"""Of larger pages a file holds fewer: about so many bytes of payload by the mean of all pages, which lie in the files in the order of a hash."""

FRAME_BYTES = 16_000_000
"""A task hands on what it has read after so many bytes of payload, or after one larger record."""

PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_END = "\r\n"


def _digests(html: pd.Series) -> pd.Series:
    return html.map(lambda x: base64.b32encode(hashlib.sha1((x or "").encode()).digest()).decode())


def payload_digest(html: str) -> Column:
    """Upper-case base32 SHA-1 of the text in UTF-8; NULL counts as empty."""
    return F.pandas_udf(_digests, "string")(html)


def _record_id(page_id: Column) -> Column:
    h = F.md5(F.concat(F.lit("page:"), page_id.cast("string")))
    parts = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def resolve(headers: DataFrame) -> DataFrame:
    """``headers`` (page_id, payload_digest, ...) with ``refers_to``: the largest page of the digest, NULL for that page itself.

    The aggregate is merged map-side, so a digest shared by many pages costs a row for each task; only digests of several pages are joined
    back, with hot ones salted. Repeats of a page with the same payload are alike: all are responses or all revisits.
    Pages without an id revisit the largest that has one, or are responses if none has.
    """
    groups = headers.groupBy("payload_digest").agg(F.max("page_id").alias("_original"), F.count("*").alias("_n"))
    shared = groups.filter("_n > 1").select("payload_digest", "_original")
    joined = skew_join(headers, shared, ["payload_digest"], "page_id", how="left")
    same = F.col("page_id").eqNullSafe(F.col("_original"))
    return joined.withColumn("refers_to", F.when(~same, F.col("_original"))).drop("_original")


def _lines(*fields: tuple[str, Column]) -> Column:
    made = [F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit(_END)) for name, value in fields]
    return F.concat_ws("", *made)  # a field that is NULL is left out


def records(pages: DataFrame, date: str = DATE) -> DataFrame:
    """The text of one WARC record for each row of pages (page_id, url, html, payload_digest, payload_bytes, refers_to).

    A row without url gets a ``urn:`` address; line ends in an address are escaped.
    """
    page = F.col("page_id")
    html = F.coalesce(F.col("html"), F.lit(""))
    revisit = F.col("refers_to").isNotNull()
    url = F.regexp_replace(F.regexp_replace(F.coalesce("url", F.concat(F.lit("urn:page:"), F.coalesce(page.cast("string"), F.lit("none")))), "\r", "%0D"), "\n", "%0A")
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{_END}"),
        _lines(("Content-Type", F.lit("text/html; charset=utf-8")), ("Content-Length", F.col("payload_bytes"))),
        F.lit(_END),
    )
    block = F.when(revisit, http).otherwise(F.concat(http, html))
    head = F.concat(
        F.lit(f"WARC/1.1{_END}"),
        _lines(
            ("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
            ("WARC-Record-ID", _record_id(F.coalesce(page.cast("string"), F.lit("none")))),
            ("WARC-Date", F.lit(date)),
            ("WARC-Target-URI", url),
            ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
            ("WARC-Refers-To", F.when(revisit, _record_id(F.col("refers_to")))),
            ("WARC-Profile", F.when(revisit, F.lit(PROFILE))),
            ("X-Page-ID", page),
            ("X-Refers-To-Page-ID", F.col("refers_to")),
            ("Content-Type", F.lit("application/http; msgtype=response")),
            ("Content-Length", F.octet_length(block)),
        ),
        F.lit(_END),
    )
    return pages.select(F.concat(head, block).alias("record"))


def write_archives(pages: DataFrame, path: str, date: str = DATE) -> None:
    """Write the pages (page_id, url, html) as gzipped WARC files without repeated payloads to the folder ``path``.

    A NULL html is an empty payload, and empty payloads are equal like others. Further columns are not read. An empty table writes no record.
    """
    pages = pages.select("page_id", "url", "html")
    payload = F.coalesce(F.col("html"), F.lit(""))
    headers = pages.select("page_id", payload_digest("html").alias("payload_digest"), F.octet_length(payload).cast("long").alias("payload_bytes"))
    headers = cut(headers, "warc-headers")
    mean = headers.agg(F.avg("payload_bytes")).first()[0] or 0.0
    resolved = resolve(headers)
    # Repeats of a page differ by payload at most, so page and digest together are a key once repeats are dropped.
    resolved = resolved.dropDuplicates(["page_id", "payload_digest"])
    known = pages.withColumn("payload_digest", payload_digest("html"))
    joined = known.alias("p").join(
        resolved.alias("h"),
        F.expr("p.page_id <=> h.page_id and p.payload_digest = h.payload_digest"),
    ).select("p.page_id", "p.url", "p.html", "p.payload_digest", "h.payload_bytes", "h.refers_to")
    writer = records(joined, date).write.option("lineSep", _END * 2).option("compression", "gzip")
    writer.option("maxRecordsPerFile", max(1, min(RECORDS_PER_FILE, int(FILE_BYTES / max(mean, 1.0))))).text(path)


def parse_records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields and block of each record of one archive file, one in memory at a time."""
    stream = io.BytesIO(data)
    stream = io.BufferedReader(gzip.GzipFile(fileobj=stream), 1 << 20) if data[:2] == b"\x1f\x8b" else stream
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no WARC record: {line[:80]!r}")
        head: dict[str, str] = {}
        while line := stream.readline().rstrip(b"\r\n"):
            name, _, value = line.decode().partition(":")
            head[name.lower()] = value.strip()
        yield head, stream.read(int(head["content-length"]))


def _long(text: str | None) -> int | None:
    return None if text is None else int(text)


_READ = ["page_id", "url", "record_type", "stated_digest", "digest", "size", "refers_to", "html"]


def _read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    def frame(rows: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame(rows, columns=_READ).astype({"page_id": "Int64", "size": "Int64", "refers_to": "Int64"})

    for batch in batches:
        for data in batch.content:
            rows, held = [], 0
            for head, block in parse_records(data):
                payload = block.partition(b"\r\n\r\n")[2]
                revisit = head["warc-type"] == "revisit"
                rows.append((
                    _long(head.get("x-page-id")), head["warc-target-uri"], head["warc-type"],
                    head["warc-payload-digest"].removeprefix("sha1:"),
                    None if revisit else base64.b32encode(hashlib.sha1(payload).digest()).decode(),
                    None if revisit else len(payload), _long(head.get("x-refers-to-page-id")),
                    None if revisit else payload.decode(),
                ))
                held += len(payload)
                if held >= FRAME_BYTES:
                    yield frame(rows)
                    rows, held = [], 0
            yield frame(rows)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """The records of all files in ``path``: page_id, url, record_type, stated_digest, digest and size of the payload in the file, refers_to, html."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")
    schema = "page_id long, url string, record_type string, stated_digest string, digest string, size long, refers_to long, html string"
    return files.mapInPandas(_read, schema)


def resolve_revisits(read: DataFrame) -> DataFrame:
    """Each record with size and digest of its full payload; a revisit has those of the response that its stated digest names.

    A revisit whose response is not in the archives keeps its row, with NULL size and digest.
    """
    own = read.select("page_id", "record_type", "refers_to", F.col("stated_digest").alias("_key"), F.col("digest").alias("_d"), F.col("size").alias("_s"))
    responses, revisits = own.filter("record_type = 'response'"), own.filter("record_type = 'revisit'")
    wanted = revisits.select("_key").distinct()
    originals = responses.join(wanted, "_key", "left_semi").groupBy("_key").agg(F.max("_d").alias("_od"), F.max("_s").alias("_os"))
    joined = skew_join(revisits, originals, ["_key"], "page_id", how="left")
    columns = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    direct = responses.withColumnsRenamed({"_d": "payload_digest", "_s": "payload_bytes"}).select(*columns)
    return direct.unionByName(joined.withColumnsRenamed({"_od": "payload_digest", "_os": "payload_bytes"}).select(*columns))


def roundtrip(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Write the archives to the shared scratch folder, read them back and resolve their revisits."""
    path = new_folder(spark, "warc")
    write_archives(pages, path)
    read = cut(read_archives(spark, path).drop("html", "url"), "warc-read")
    return resolve_revisits(read)
