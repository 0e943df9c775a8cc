"""Run registered queries in Spark and their oracle SQL in DuckDB; compare.

    python tools/check_oracle.py [sf_dir] [name ...]

Compares column names, row counts and the multiset of rows (values
normalised: dates/timestamps to ISO text, floats rounded to 6 places).
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, bool):
        return v
    if isinstance(v, int):
        return v
    return str(v)


def _key(row):
    return tuple((x is None, str(type(x)), x if x is not None else "") for x in row)


def duck_conn(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def compare(spark, con, name, fn, sql, sf_dir, verbose=True):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(_norm(x) for x in r) for r in sdf.collect()]
    t1 = time.time()
    if sql is None:
        return {"name": name, "ok": None, "rows": len(s_rows), "spark_s": round(t1 - t0, 2)}
    res = con.execute(sql)
    d_cols = [c[0] for c in res.description]
    d_rows = [tuple(_norm(x) for x in r) for r in res.fetchall()]
    t2 = time.time()
    out = {"name": name, "rows": len(s_rows), "oracle_rows": len(d_rows),
           "spark_s": round(t1 - t0, 2), "duck_s": round(t2 - t1, 2)}
    if sorted(s_cols) != sorted(d_cols):
        out.update(ok=False, why=f"columns spark={s_cols} duck={d_cols}")
        return out
    idx = [d_cols.index(c) for c in s_cols]
    d_rows = [tuple(r[i] for i in idx) for r in d_rows]
    a, b = sorted(s_rows, key=_key), sorted(d_rows, key=_key)
    if a == b:
        out["ok"] = True
    else:
        sa, sb = set(a), set(b)
        out.update(ok=False, why=f"spark-only={list(sa - sb)[:3]} duck-only={list(sb - sa)[:3]}")
    return out


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 and argv[1].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in argv[1:] if not a.startswith("/")]
    from custfold.catalog import REGISTRY, load_all
    from custfold.session import get_spark
    load_all()
    spark = get_spark()
    spark.sparkContext.setLogLevel("FATAL")
    con = duck_conn(sf_dir)
    bad = 0
    for name, (fn, sql) in REGISTRY.items():
        if names and name not in names:
            continue
        try:
            r = compare(spark, con, name, fn, sql, sf_dir)
        except Exception as exc:  # report and continue
            r = {"name": name, "ok": False, "why": f"{type(exc).__name__}: {str(exc)[:400]}"}
        bad += r.get("ok") is False
        print(r, flush=True)
    print("FAILED", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
