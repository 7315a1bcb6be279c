"""Order-insensitive comparison of a Spark result with DuckDB SQL.

Used by the tests and ``scripts/check_oracle.py``: both sides are brought
to pandas, columns sorted by name, values normalised to text and the row
multisets compared.
"""

from __future__ import annotations

import datetime as _dt
import decimal
from collections import Counter

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def duckdb_connection(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir.rstrip('/')}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return "NULL"
    try:
        import pandas as pd

        if v is pd.NaT or (isinstance(v, float) and v != v):
            return "NULL"
    except ImportError:  # pragma: no cover
        pass
    if isinstance(v, (bytes, bytearray, memoryview)):
        return bytes(v).hex()
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, decimal.Decimal):
        return format(v.normalize(), "f") if v == v else "NULL"
    if isinstance(v, float):
        return repr(v)
    if isinstance(v, (_dt.datetime, _dt.date)):
        return v.isoformat()
    if hasattr(v, "item"):
        return _norm(v.item())
    return str(v)


def rows_of(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [c for c in sorted(columns)], Counter(tuple(_norm(r[i]) for i in order) for r in records)


def compare(spark_df, con, sql: str) -> dict:
    s_cols = list(spark_df.columns)
    s_rows = [tuple(r) for r in spark_df.collect()]
    rel = con.sql(sql)
    d_cols = list(rel.columns)
    d_rows = rel.fetchall()
    sc, sr = rows_of(s_cols, s_rows)
    dc, dr = rows_of(d_cols, d_rows)
    out = {
        "spark_rows": len(s_rows),
        "oracle_rows": len(d_rows),
        "columns_match": sc == dc,
        "values_match": sc == dc and sr == dr,
    }
    if not out["values_match"]:
        out["spark_columns"] = sc
        out["oracle_columns"] = dc
        out["only_spark"] = list((sr - dr).items())[:3]
        out["only_oracle"] = list((dr - sr).items())[:3]
    return out
