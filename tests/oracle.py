"""Compare a registered query with its SQL in DuckDB, ignoring row and column order."""

from __future__ import annotations

import glob
import os

import duckdb
import numpy as np
import pandas as pd


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    return con


def canonical(df: pd.DataFrame) -> list[tuple]:
    df = df[sorted(df.columns)]
    rows = []
    for row in df.itertuples(index=False, name=None):
        out = []
        for v in row:
            if v is None or v is pd.NA or v is pd.NaT or (isinstance(v, float) and np.isnan(v)):
                out.append((0, ""))
            elif isinstance(v, (bool, np.bool_)):
                out.append((1, str(bool(v))))
            elif isinstance(v, (int, float, np.integer, np.floating)):
                out.append((1, f"{float(v) + 0.0:.6f}" if float(v) != 0 else "0.000000"))
            else:
                out.append((1, str(v)))
        rows.append(tuple(out))
    return sorted(rows)


def differences(got: pd.DataFrame, want: pd.DataFrame) -> str | None:
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} != {sorted(want.columns)}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    for c in got.columns:
        g, w = pd.api.types.is_numeric_dtype(got[c]), pd.api.types.is_numeric_dtype(want[c])
        if g != w and got[c].notna().any():
            return f"type of {c}: {got[c].dtype} != {want[c].dtype}"
    a, b = canonical(got), canonical(want)
    bad = [(x, y) for x, y in zip(a, b, strict=True) if x != y]
    return f"{len(bad)} of {len(a)} rows differ, first {bad[0]}" if bad else None
