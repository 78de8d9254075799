"""Compare a registered query with its DuckDB oracle, columns by name, rows as a bag."""

from __future__ import annotations

import glob
import os

import duckdb
import pandas as pd


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def normal(pdf: pd.DataFrame) -> list[tuple]:
    pdf = pdf[sorted(pdf.columns)]

    def cell(v):
        if v is None or v is pd.NA or (isinstance(v, float) and v != v):
            return None
        if hasattr(v, "item"):
            v = v.item()
        if isinstance(v, float):
            return round(v, 9)
        return v

    rows = [tuple(cell(v) for v in row) for row in pdf.itertuples(index=False, name=None)]
    return sorted(rows, key=repr)


def difference(spark, name: str, fn, sql: str, sf_dir: str) -> str | None:
    """None when equal, else what differs."""
    got = fn(spark, sf_dir).toPandas()
    want = duck(sf_dir).sql(sql).df()
    if sorted(got.columns) != sorted(want.columns):
        return f"{name}: columns {sorted(got.columns)} != {sorted(want.columns)}"
    a, b = normal(got), normal(want)
    if len(a) != len(b):
        return f"{name}: {len(a)} rows, expected {len(b)}"
    for left, right in zip(a, b):
        if left != right:
            bad = [(c, l, r) for c, l, r in zip(sorted(got.columns), left, right) if l != r]
            return f"{name}: {bad[:3]!r}"
    return None
