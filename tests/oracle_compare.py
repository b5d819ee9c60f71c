"""Compare registered Spark queries with their DuckDB oracle SQL.

Mirrors the driver's check: row count, sorted column names, and an
order-insensitive comparison of values (floats rounded).
Usage: python tests/oracle_compare.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return ("~",)
    if isinstance(v, float):
        if math.isnan(v):
            return ("~",)
        return round(v, 5)
    if hasattr(v, "item"):
        return _norm(v.item())
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def rows_of(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in records]
    return sorted(out, key=repr)


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    srows = [tuple(r) for r in sdf.collect()]
    scols = sdf.columns
    t1 = time.time()
    rel = con.sql(sql)
    dcols = rel.columns
    drows = rel.fetchall()
    t2 = time.time()
    ok_cols = sorted(scols) == sorted(dcols)
    ok_n = len(srows) == len(drows)
    a, b = rows_of(scols, srows), rows_of(dcols, drows)
    ok_v = a == b
    diff = None
    if not ok_v:
        sa, sb = set(a), set(b)
        diff = (list(sa - sb)[:3], list(sb - sa)[:3])
    return dict(name=name, cols=ok_cols, rows=ok_n, values=ok_v, n=len(srows), nd=len(drows),
                spark_s=round(t1 - t0, 2), duck_s=round(t2 - t1, 2), diff=diff,
                scols=scols, dcols=dcols)


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    import __spark_entry__ as E
    from reuselens.session import get_spark
    spark = get_spark("local[8]", shuffle_partitions=8)
    con = duck(sf_dir)
    qs, sq = E.queries(), E.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if names and name not in names:
            continue
        if name not in sq:
            t0 = time.time()
            n = fn(spark, sf_dir).count()
            print(f"{name:28s} rows-only n={n} {time.time()-t0:.1f}s", flush=True)
            continue
        try:
            r = compare(spark, con, name, fn, sq[name], sf_dir)
        except Exception as e:  # noqa: BLE001
            bad += 1
            print(f"{name:28s} ERROR {type(e).__name__}: {str(e)[:400]}", flush=True)
            continue
        ok = r["cols"] and r["rows"] and r["values"]
        bad += not ok
        print(f"{name:28s} {'OK ' if ok else 'BAD'} n={r['n']}/{r['nd']} spark={r['spark_s']}s "
              f"duck={r['duck_s']}s" + ("" if ok else f" cols={r['scols']}/{r['dcols']} diff={r['diff']}"),
              flush=True)
    print("mismatches:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
