"""Side-by-side check of catalog queries against their DuckDB oracles:
same column names, same row count, same multiset of normalised rows."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import time
from collections import Counter

from daybook.sources.tables import TABLES


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, (float, decimal.Decimal)):
        f = float(v)
        if math.isnan(f):
            return "nan"
        return round(f, 6)
    if isinstance(v, dt.datetime):
        if v.tzinfo is not None:
            v = v.astimezone(dt.timezone.utc).replace(tzinfo=None)
        return v.isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, norm(x)) for k, x in v.items()))
    return v


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [tuple(norm(r[i]) for i in order) for r in rows]


def compare_one(spark, con, sf_dir, name, fn, sql):
    t0 = time.time()
    df = fn(spark, sf_dir)
    s_cols = df.columns
    s_rows = rows_of(s_cols, df.collect())
    t1 = time.time()
    if sql is None:
        return {"ok": None, "rows": len(s_rows), "spark_s": round(t1 - t0, 2)}
    cur = con.execute(sql)
    d_cols = [c[0] for c in cur.description]
    d_rows = rows_of(d_cols, cur.fetchall())
    res = {"rows": len(s_rows), "oracle_rows": len(d_rows), "spark_s": round(t1 - t0, 2)}
    if sorted(s_cols) != sorted(d_cols):
        res.update(ok=False, why=f"columns {sorted(s_cols)} vs {sorted(d_cols)}")
        return res
    a, b = Counter(s_rows), Counter(d_rows)
    if a != b:
        only_s = list((a - b).elements())[:3]
        only_d = list((b - a).elements())[:3]
        res.update(ok=False, why=f"spark-only {only_s} oracle-only {only_d}")
        return res
    res["ok"] = True
    return res
