"""Run catalogue queries in Spark and their oracle SQL in DuckDB; compare results.

Usage: python tests/oracle_compare.py [sf_dir] [name ...]
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

from fintide.session import build_session  # noqa: E402
from fintide.sources.testviews import TABLES  # noqa: E402


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return float(v)
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    return v


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    scols = sdf.columns
    srows = [tuple(norm(r[c]) for c in scols) for r in sdf.collect()]
    t1 = time.time()
    if sql is None:
        return dict(name=name, ok=None, rows=len(srows), spark_s=round(t1 - t0, 2))
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drows = [tuple(norm(x) for x in r) for r in res.fetchall()]
    info = dict(name=name, rows=len(srows), oracle_rows=len(drows), spark_s=round(t1 - t0, 2))
    if sorted(scols) != sorted(dcols):
        return dict(info, ok=False, why=f"columns {sorted(scols)} vs {sorted(dcols)}")
    order = sorted(scols)
    si = [scols.index(c) for c in order]
    di = [dcols.index(c) for c in order]
    key = lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r)
    s_sorted = sorted((tuple(r[i] for i in si) for r in srows), key=key)
    d_sorted = sorted((tuple(r[i] for i in di) for r in drows), key=key)
    if s_sorted == d_sorted:
        return dict(info, ok=True)
    diffs = [(a, b) for a, b in zip(s_sorted, d_sorted) if a != b][:3]
    return dict(info, ok=False, why=f"{order} first diffs {diffs}")


def main():
    args = sys.argv[1:]
    sf_dir = args.pop(0) if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    import __spark_entry__ as E

    qs, oracle = E.queries(), E.oracle_sql()
    names = args or list(qs)
    spark = build_session()
    con = duck(sf_dir)
    bad = 0
    for n in names:
        try:
            r = compare(spark, con, n, qs[n], oracle.get(n), sf_dir)
        except Exception as e:  # report and continue
            r = dict(name=n, ok=False, why=f"{type(e).__name__}: {str(e)[:400]}")
        bad += r.get("ok") is False
        print(r, flush=True)
    print(f"{len(names) - bad}/{len(names)} not failing")


if __name__ == "__main__":
    main()
