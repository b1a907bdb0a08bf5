"""Compare a Spark result with an independent SQL result (DuckDB), row by row.

Used by the tests and ``scripts/check_oracle.py``. Columns are compared by
name, rows as a multiset; nullable integers that pandas turns into floats are
normalised back.
"""

from __future__ import annotations

import math
import os

import duckdb
import pandas as pd

from strata.sources.testdata import TABLES


def canon(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NULL"
        if v.is_integer() and abs(v) < 2 ** 53:
            return str(int(v))  # nullable ints arrive as floats from pandas
        return repr(float(v) + 0.0)
    if isinstance(v, pd.Timestamp):
        return v.isoformat()
    if hasattr(v, "isoformat"):
        return pd.Timestamp(v).isoformat()
    if isinstance(v, (bool,)):
        return str(v)
    try:
        import numpy as np
        if isinstance(v, np.generic):
            return canon(v.item())
    except Exception:
        pass
    return str(v)


def rows_of(pdf: pd.DataFrame):
    cols = sorted(pdf.columns)
    pdf = pdf[cols].astype(object).where(pdf[cols].notna(), None)
    return cols, sorted(tuple(canon(v) for v in r) for r in pdf.itertuples(index=False, name=None))


def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"create view {t} as select * from read_parquet('{p}')")
    return con


def compare(spark_pdf: pd.DataFrame, oracle_pdf: pd.DataFrame) -> str | None:
    """None when equal, else a short reason."""
    sc, sr = rows_of(spark_pdf)
    oc, orr = rows_of(oracle_pdf)
    if sc != oc:
        return f"columns spark={sc} oracle={oc}"
    if len(sr) != len(orr):
        return f"rows spark={len(sr)} oracle={len(orr)}"
    if sr != orr:
        diff = [(a, b) for a, b in zip(sr, orr) if a != b][:3]
        return f"values differ, e.g. {diff}"
    return None
