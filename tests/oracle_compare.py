"""Spark-vs-DuckDB comparison used by the tests and by hand.

Mirrors the driver's gate: same row count, same column names (sorted), and
the same multiset of rows after sorting columns by name.
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return round(v, 9)
    if isinstance(v, dt.datetime):
        if v.tzinfo is not None:
            v = v.astimezone(dt.timezone.utc).replace(tzinfo=None)
        return v.isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return _norm(v.asDict(recursive=True))
    return v


def compare(spark, con, name: str, fn, sql: str, sf_dir: str) -> tuple[bool, str]:
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    rel = con.sql(sql)
    d_cols = rel.columns
    d_rows = rel.fetchall()
    if sorted(s_cols) != sorted(d_cols):
        return False, f"columns differ: spark={s_cols} duck={d_cols}"
    order_s = sorted(range(len(s_cols)), key=lambda i: s_cols[i])
    order_d = sorted(range(len(d_cols)), key=lambda i: d_cols[i])
    a = sorted((tuple(_norm(r[i]) for i in order_s) for r in s_rows), key=repr)
    b = sorted((tuple(_norm(r[i]) for i in order_d) for r in d_rows), key=repr)
    if len(a) != len(b):
        return False, f"row count spark={len(a)} duck={len(b)}"
    if a != b:
        diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
        names = sorted(s_cols)
        return False, f"values differ ({sum(1 for x, y in zip(a, b) if x != y)} rows), cols={names}, first={diff}"
    return True, f"{len(a)} rows"


def main(argv):
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as entry
    from barwatch.session import build_session

    sf_dir = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    names = argv or sorted(entry.oracle_sql())
    spark = build_session()
    con = duck(sf_dir)
    qs, sqls = entry.queries(), entry.oracle_sql()
    bad = 0
    for n in names:
        if n not in sqls:
            print(f"SKIP {n}: no oracle")
            continue
        try:
            ok, msg = compare(spark, con, n, qs[n], sqls[n], sf_dir)
        except Exception as e:  # report and continue
            ok, msg = False, f"{type(e).__name__}: {str(e)[:400]}"
        bad += not ok
        print(("OK  " if ok else "FAIL") + f" {n}: {msg}", flush=True)
    print(f"{len(names) - bad}/{len(names)} ok")


if __name__ == "__main__":
    main(sys.argv[1:])
