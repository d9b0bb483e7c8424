"""Run registered queries in Spark and their SQL oracles in DuckDB; compare.

Usage: python tests/oracle_check.py [sf_dir] [name ...]
Compares column names (sorted), row counts and the order-free multiset of
rows (doubles compared after rounding to 6 digits).
"""

from __future__ import annotations

import math
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6) + 0.0
    return v


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    names = [cols[i] for i in order]
    out = sorted((tuple(norm(r[i]) for i in order) for r in rows), key=repr)
    return names, out


def compare(spark, con, name, fn, sql, sf_dir):
    t = time.time()
    sdf = fn(spark, sf_dir)
    srows = [tuple(r) for r in sdf.collect()]
    ts = time.time() - t
    cur = con.execute(sql)
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    sn, sv = canon(sdf.columns, srows)
    dn, dv = canon(dcols, drows)
    ok = sn == dn and len(sv) == len(dv) and sv == dv
    detail = ""
    if not ok:
        if sn != dn:
            detail = f"cols spark={sn} duck={dn}"
        elif len(sv) != len(dv):
            detail = f"rows spark={len(sv)} duck={len(dv)}"
        else:
            diffs = [(a, b) for a, b in zip(sv, dv) if a != b]
            detail = f"{len(diffs)} differing rows, e.g. {diffs[:2]}"
    return ok, ts, len(srows), detail


def main():
    from __spark_entry__ import oracle_sql, queries
    from txnlab.session import build_session

    args = sys.argv[1:]
    sf_dir = "/root/testdata/sf0.01"
    if args and args[0].startswith("/"):
        sf_dir, args = args[0], args[1:]
    spark = build_session("local[8]", shuffle_partitions=8)
    con = duck(sf_dir)
    qs, os_ = queries(), oracle_sql()
    names = args or sorted(os_)
    bad = 0
    for n in names:
        try:
            ok, ts, nrows, detail = compare(spark, con, n, qs[n], os_[n], sf_dir)
        except Exception as e:  # noqa: BLE001
            ok, ts, nrows, detail = False, 0.0, -1, f"ERROR {type(e).__name__}: {str(e)[:300]}"
        bad += not ok
        print(f"{'OK ' if ok else 'BAD'} {n:28s} {ts:6.2f}s rows={nrows} {detail}", flush=True)
    print(f"{len(names) - bad}/{len(names)} match")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
