"""Compare each query with its SQL twin in an in-process DuckDB, on one data folder."""

from __future__ import annotations

import glob
import os
import time

import duckdb
import pandas as pd


def connect(folder: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _rows(df: pd.DataFrame) -> list[tuple]:
    df = df[sorted(df.columns)]
    out = [tuple(None if pd.isna(v) else v for v in r) for r in df.itertuples(index=False)]
    return sorted(out, key=repr)


def _kind(dtype) -> str:
    return {"i": "int", "u": "int", "f": "float", "b": "bool"}.get(dtype.kind, "other")


def compare(spark, con, folder: str, query, sql: str | None) -> str:
    began = time.time()
    got = query(spark, folder).toPandas()
    took = time.time() - began
    if sql is None:
        return f"rows-only {len(got)} rows {took:.1f}s"
    want = con.execute(sql).df()
    if sorted(got.columns) != sorted(want.columns):
        return f"FAIL columns {sorted(got.columns)} != {sorted(want.columns)}"
    if len(got) != len(want):
        return f"FAIL {len(got)} rows, wanted {len(want)}"
    notes = [
        f"{c}:{got[c].dtype}/{want[c].dtype}" for c in got.columns
        if _kind(got[c].dtype) != _kind(want[c].dtype) and not got[c].isna().any()
    ]
    a, b = _rows(got.astype(object)), _rows(want.astype(object))
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    if bad:
        return f"FAIL {len(bad)} rows differ, first {bad[0]} {notes}"
    return f"ok {len(got)} rows {took:.1f}s {' '.join(notes)}"
