"""Order-insensitive comparison of a Spark result and a DuckDB result."""

from __future__ import annotations

import math

import pandas as pd


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if hasattr(v, "item"):
        return _norm(v.item())
    if isinstance(v, (pd.Timestamp,)):
        return str(v)
    return v


def rows_of(pdf: pd.DataFrame):
    cols = sorted(pdf.columns)
    out = []
    for rec in pdf[cols].itertuples(index=False, name=None):
        out.append(tuple(_norm(x) for x in rec))
    return cols, sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))


def compare(spark_df, duck_con, sql: str):
    s_cols, s_rows = rows_of(spark_df.toPandas())
    d_cols, d_rows = rows_of(duck_con.execute(sql).df())
    return s_cols, d_cols, s_rows, d_rows
