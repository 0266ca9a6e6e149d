"""Run registered queries in Spark and their SQL twins in DuckDB, compare.

Comparison mirrors the driver: column names sorted, row count, and an
order-insensitive comparison of exact values (dates and numbers normalised
to text). Usage: ``python tests/oracle_compare.py [sf_dir] [name ...]``.
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return "\x00null"
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        if v == int(v) and abs(v) < 1e15:
            return repr(float(int(v)))
        return repr(v)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if hasattr(v, "item"):
        return _norm(v.item())
    return str(v)


def rows_of(records, cols):
    return sorted(tuple(_norm(r[c]) for c in cols) for r in records)


def compare(spark, con, name, fn, sql, sf_dir):
    t = time.time()
    sdf = fn(spark, sf_dir)
    s_cols = sorted(sdf.columns)
    s_rows = rows_of([r.asDict() for r in sdf.collect()], s_cols)
    t_spark = time.time() - t
    if sql is None:
        return {"name": name, "ok": None, "rows": len(s_rows), "spark_s": round(t_spark, 2)}
    t = time.time()
    rel = con.execute(sql)
    d_cols_raw = [d[0] for d in rel.description]
    d_recs = [dict(zip(d_cols_raw, r)) for r in rel.fetchall()]
    d_cols = sorted(d_cols_raw)
    d_rows = rows_of(d_recs, d_cols)
    t_duck = time.time() - t
    res = {"name": name, "rows": len(s_rows), "oracle_rows": len(d_rows), "spark_s": round(t_spark, 2),
           "duck_s": round(t_duck, 2)}
    if s_cols != d_cols:
        res.update(ok=False, why=f"columns {s_cols} vs {d_cols}")
    elif len(s_rows) != len(d_rows):
        res.update(ok=False, why="row count")
    elif s_rows != d_rows:
        diff = [(a, b) for a, b in zip(s_rows, d_rows) if a != b][:3]
        res.update(ok=False, why=f"values, e.g. {diff}")
    else:
        res.update(ok=True)
    return res


def main(argv):
    sf_dir = "/root/testdata/sf0.01"
    names = []
    for a in argv:
        if a.startswith("/"):
            sf_dir = a
        else:
            names.append(a)
    import __spark_entry__ as entry
    from demand.session import local_session
    spark = local_session(8)
    qs, sqls = entry.queries(), entry.oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for name in names or list(qs):
        try:
            r = compare(spark, con, name, qs[name], sqls.get(name), sf_dir)
        except Exception as e:  # report and continue
            r = {"name": name, "ok": False, "why": f"{type(e).__name__}: {str(e)[:300]}"}
        bad += r.get("ok") is False
        print(r, flush=True)
    print("FAILED" if bad else "ALL OK", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
