"""Side-by-side check: a registered Spark query vs its DuckDB twin.

Usable from pytest and as a script:  python tests/oracle.py [key ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")
TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck_connect(sf_dir: str = SF_DIR):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6) + 0.0
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6) + 0.0
    if isinstance(v, int):
        return v
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((str(k), _norm(x)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return tuple(_norm(x) for x in v)
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return [sorted(cols)], sorted(out, key=repr)


def compare(name: str, spark, con=None, sf_dir: str = SF_DIR, verbose: bool = False):
    from duetlog.catalog import registry
    registry.load_all()
    con = con or duck_connect(sf_dir)
    t0 = time.time()
    sdf = registry.run(name, spark, sf_dir)
    s_cols = sdf.columns
    s_rows = sdf.collect()
    t1 = time.time()
    sql = registry.ORACLE.get(name)
    if sql is None:
        return {"name": name, "ok": None, "rows": len(s_rows), "spark_sec": t1 - t0}
    cur = con.execute(sql)
    d_cols = [c[0] for c in cur.description]
    d_rows = cur.fetchall()
    sc, sr = _rows(s_cols, s_rows)
    dc, dr = _rows(d_cols, d_rows)
    res = {"name": name, "rows": len(s_rows), "oracle_rows": len(d_rows),
           "cols_ok": sc == dc, "vals_ok": sr == dr, "spark_sec": round(t1 - t0, 2)}
    res["ok"] = res["cols_ok"] and res["vals_ok"]
    if verbose and not res["ok"]:
        res["spark_cols"], res["duck_cols"] = s_cols, d_cols
        diff_s = [r for r in sr if r not in set(dr)][:3]
        diff_d = [r for r in dr if r not in set(sr)][:3]
        res["only_spark"], res["only_duck"] = diff_s, diff_d
    return res


if __name__ == "__main__":
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from duetlog.session import get_session
    from duetlog.catalog import registry
    spark = get_session("local[8]", shuffle_partitions=8)
    registry.load_all()
    keys = sys.argv[1:] or sorted(registry.QUERIES)
    con = duck_connect()
    bad = 0
    for k in keys:
        try:
            r = compare(k, spark, con, verbose=True)
        except Exception as e:  # report and go on
            r = {"name": k, "ok": False, "error": repr(e)[:600]}
        if r.get("ok") is False:
            bad += 1
        print(r, flush=True)
    print(f"FAILED {bad} of {len(keys)}")
