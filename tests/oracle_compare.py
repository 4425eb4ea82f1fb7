"""Side-by-side check of a registered Spark query against its DuckDB oracle."""

from __future__ import annotations

import math
from datetime import date, datetime

import duckdb
import pandas as pd

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return v
    if isinstance(v, pd.Timestamp):
        return v.to_pydatetime().isoformat(sep=" ")
    if isinstance(v, datetime):
        return v.isoformat(sep=" ")
    if isinstance(v, date):
        return v.isoformat()
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def rows_of(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_norm(r[i]) for i in order) for r in records]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


def compare(spark, con, name: str, spark_df, oracle_sql: str, rel_tol: float = 0.0):
    """Return (ok, message). Exact comparison unless ``rel_tol`` is given."""
    s_cols = spark_df.columns
    s_rows = [tuple(r) for r in spark_df.collect()]
    res = con.execute(oracle_sql)
    o_cols = [d[0] for d in res.description]
    o_rows = res.fetchall()
    if sorted(s_cols) != sorted(o_cols):
        return False, f"{name}: columns differ\n spark={sorted(s_cols)}\n oracle={sorted(o_cols)}"
    if len(s_rows) != len(o_rows):
        return False, f"{name}: row count spark={len(s_rows)} oracle={len(o_rows)}"
    a, b = rows_of(s_cols, s_rows), rows_of(o_cols, o_rows)
    cols = sorted(s_cols)
    bad = 0
    first = None
    for ra, rb in zip(a, b):
        for c, x, y in zip(cols, ra, rb):
            same = x == y
            if not same and isinstance(x, float) and isinstance(y, float) and rel_tol:
                same = math.isclose(x, y, rel_tol=rel_tol, abs_tol=1e-12)
            if not same:
                bad += 1
                if first is None:
                    first = (c, x, y, ra, rb)
    if bad:
        c, x, y, ra, rb = first
        return False, f"{name}: {bad} differing values; first col={c} spark={x!r} oracle={y!r}\n  spark row={ra}\n  oracle row={rb}"
    return True, f"{name}: {len(s_rows)} rows equal"
