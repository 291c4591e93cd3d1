"""Side-by-side check of a Spark query against its DuckDB oracle SQL.

Mirrors the driver's gate: row count, column names, and an order-insensitive
comparison of values (floats rounded, columns sorted by name).
"""

from __future__ import annotations

import datetime as _dt
import decimal
import math

import numpy as np

from tessera.sources.tables import BASE_TABLES

FLOAT_DIGITS = 6


def duck_connect(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    con.sql("SET TimeZone='UTC'")
    for t in BASE_TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    try:
        import pandas as pd
        if v is pd.NA or v is pd.NaT:
            return None
    except Exception:
        pass
    if isinstance(v, (float, np.floating)):
        f = float(v)
        if math.isnan(f):
            return None
        if math.isinf(f):
            return "inf" if f > 0 else "-inf"
        r = round(f, FLOAT_DIGITS)
        if r == 0:
            r = 0.0
        if r == int(r) and abs(r) < 2**53:
            return int(r)
        return r
    if isinstance(v, decimal.Decimal):
        return _norm(float(v))
    if isinstance(v, (bool, np.bool_)):
        return bool(v)
    if isinstance(v, (int, np.integer)):
        return int(v)
    if isinstance(v, (list, tuple, np.ndarray)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple((k, _norm(x)) for k, x in sorted(v.items()))
    if isinstance(v, (_dt.datetime, _dt.date)):
        return v.isoformat()
    if hasattr(v, "asDict"):
        return _norm(v.asDict())
    try:
        import pandas as pd
        if v is pd.NaT:
            return None
        if isinstance(v, pd.Timestamp):
            return v.isoformat()
    except Exception:
        pass
    return v


def _rows(pdf):
    cols = sorted(pdf.columns)
    out = []
    for rec in pdf[cols].itertuples(index=False, name=None):
        out.append(tuple(_norm(x) for x in rec))
    out.sort(key=repr)
    return cols, out


def compare(spark_df, duck_rel) -> dict:
    sp = spark_df.toPandas()
    dk = duck_rel.df()
    res = {"rows_spark": len(sp), "rows_oracle": len(dk)}
    sc, srows = _rows(sp)
    dc, drows = _rows(dk)
    res["columns_match"] = sc == dc
    if sc != dc:
        res["columns_spark"], res["columns_oracle"] = sc, dc
    res["rows_match"] = len(sp) == len(dk)
    res["values_match"] = res["columns_match"] and srows == drows
    if res["columns_match"]:
        kinds = {c: (sp[c].dtype.kind, dk[c].dtype.kind) for c in sc}
        res["dtype_diff"] = {c: k for c, k in kinds.items()
                             if k[0] != k[1] and set(k) != {"i", "f"} and "O" not in k}
    if not res["values_match"] and res["columns_match"]:
        sset, dset = set(srows), set(drows)
        res["only_spark"] = [r for r in srows if r not in dset][:3]
        res["only_oracle"] = [r for r in drows if r not in sset][:3]
    return res
