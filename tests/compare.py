"""Runs queries next to their SQL oracle and compares the rows."""

from __future__ import annotations

import math
import time

import duckdb
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET threads = 4")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _cell(v):
    if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and math.isnan(v)):
        return ("", "")
    if isinstance(v, bool) or type(v).__name__ == "bool_":
        return ("b", str(bool(v)))
    if isinstance(v, (int, float)) or hasattr(v, "dtype") and v.dtype.kind in "iuf":
        return ("n", repr(float(v)))
    if isinstance(v, pd.Timestamp):
        return ("t", v.isoformat())
    return ("s", str(v))


def rows(pdf: pd.DataFrame) -> list:
    pdf = pdf[sorted(pdf.columns)]
    return sorted(tuple(_cell(v) for v in row) for row in pdf.astype(object).itertuples(index=False))


def compare(spark, con, name, query, sql, sf_dir) -> tuple[str, float]:
    """("ok" or what differs, seconds of the Spark side)."""
    start = time.time()
    got = query(spark, sf_dir).toPandas()
    took = time.time() - start
    if sql is None:
        return ("ok (rows only)" if len(got) else "no rows"), took
    want = con.execute(sql).df()
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} / {sorted(want.columns)}", took
    left, right = rows(got), rows(want)
    if len(left) != len(right):
        return f"rows {len(left)} / {len(right)}", took
    bad = [(a, b) for a, b in zip(left, right) if a != b]
    return (f"{len(bad)} rows differ, first {bad[0]}" if bad else "ok"), took
