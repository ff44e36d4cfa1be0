"""Run each registered Spark query next to its DuckDB oracle and compare the results.

Mirrors the driver's gate: row count, column names, and an order-insensitive comparison of
all values.  Usage: ``python tests/oracle_check.py [sf_dir] [name ...]``.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def norm(v, exact: bool = False):
    if v is None:
        return ("~null",)
    if isinstance(v, bool):
        return ("b", v)
    if isinstance(v, (int, float, decimal.Decimal)) and not isinstance(v, bool):
        f = float(v)
        if math.isnan(f):
            return ("nan",)
        if exact:
            return ("n", f)
        return ("n", float(f"{f:.9g}"))
    if isinstance(v, dt.datetime):
        return ("t", v.isoformat())
    if isinstance(v, dt.date):
        return ("d", v.isoformat())
    if isinstance(v, (list, tuple)):
        return ("l", tuple(norm(x, exact) for x in v))
    return ("s", str(v))


def compare(spark, con, name, fn, sql, sf_dir, exact=False):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    if sql is None:
        return dict(name=name, ok=None, rows=len(s_rows), spark_s=round(t1 - t0, 2), note="no oracle")
    rel = con.execute(sql)
    d_cols = [d[0] for d in rel.description]
    d_rows = rel.fetchall()
    t2 = time.time()
    res = dict(name=name, rows=len(s_rows), oracle_rows=len(d_rows), spark_s=round(t1 - t0, 2), duck_s=round(t2 - t1, 2))
    if sorted(s_cols) != sorted(d_cols):
        res.update(ok=False, note=f"columns differ: spark={s_cols} duck={d_cols}")
        return res
    order = sorted(s_cols)
    si = [s_cols.index(c) for c in order]
    di = [d_cols.index(c) for c in order]
    sa = sorted(tuple(norm(r[i], exact) for i in si) for r in s_rows)
    da = sorted(tuple(norm(r[i], exact) for i in di) for r in d_rows)
    if len(sa) != len(da):
        res.update(ok=False, note="row count differs")
        return res
    if sa != da:
        bad = [(a, b) for a, b in zip(sa, da) if a != b][:3]
        res.update(ok=False, note=f"values differ, e.g. {bad}")
        return res
    res.update(ok=True)
    return res


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 and os.path.isdir(argv[1]) else "/root/testdata/sf0.01"
    names = [a for a in argv[1:] if not os.path.isdir(a)]
    import __spark_entry__ as E
    from paneltide.session import local_session

    spark = local_session(8)
    con = duck(sf_dir)
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if names and name not in names:
            continue
        try:
            r = compare(spark, con, name, fn, sqls.get(name), sf_dir, exact="--exact" in argv)
        except Exception as e:  # noqa: BLE001
            r = dict(name=name, ok=False, note=f"error: {type(e).__name__}: {str(e)[:400]}")
        bad += r.get("ok") is False
        print(r, flush=True)
    print(f"failures: {bad}")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
