"""Result comparison shared by the oracle tool and the tests (order-insensitive)."""
from __future__ import annotations

import datetime as dt
import decimal
import json
import math
import os

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return [norm(x) for x in v]
    if isinstance(v, dict):
        return {k: norm(x) for k, x in sorted(v.items())}
    return v


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [json.dumps([norm(r[i]) for i in order], default=str) for r in rows]
    return [cols[i] for i in order], sorted(out)


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def compare(df, con, sql) -> str:
    """'OK n=..' or a description of the first difference."""
    cols = df.columns
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(sql)
    ocols = [d[0] for d in res.description]
    a, b = canon(cols, rows), canon(ocols, res.fetchall())
    if a[0] != b[0]:
        return f"COLS spark={a[0]} duck={b[0]}"
    if len(a[1]) != len(b[1]):
        return f"COUNT spark={len(a[1])} duck={len(b[1])}"
    if a[1] != b[1]:
        return f"VALUES {[(x, y) for x, y in zip(a[1], b[1]) if x != y][:2]}"
    return f"OK n={len(rows)}"
