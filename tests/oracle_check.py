"""Run registered queries against their DuckDB twins, the way the test driver does.

usage: python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time

import duckdb  # noqa: I001

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NULL"
        return repr(round(v, 6))
    if isinstance(v, decimal.Decimal):
        return repr(round(float(v), 6))
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(norm(x) for x in v) + "]"
    if isinstance(v, dict):
        return "{" + ",".join(f"{k}:{norm(x)}" for k, x in sorted(v.items())) + "}"
    if hasattr(v, "asDict"):
        return norm(v.asDict())
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, int):
        return str(v)
    return str(v)


def spark_rows(df):
    cols = sorted(df.columns)
    return cols, sorted(tuple(norm(r[c]) for c in cols) for r in df.select(*cols).collect())


def duck_rows(con, sql):
    rel = con.sql(sql)
    names = rel.columns
    cols = sorted(names)
    idx = [names.index(c) for c in cols]
    return cols, sorted(tuple(norm(r[i]) for i in idx) for r in rel.fetchall())


def connect(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def check(spark, sf_dir, names=None, verbose=True):
    sys.path.insert(0, "/root/repo")
    import __spark_entry__ as E
    qs, sqls = E.queries(), E.oracle_sql()
    con = connect(sf_dir)
    results = {}
    for name in names or list(qs):
        t0 = time.time()
        try:
            cols, rows = spark_rows(qs[name](spark, sf_dir))
        except Exception as e:  # noqa: BLE001
            results[name] = f"SPARK ERROR {type(e).__name__}: {str(e)[:300]}"
            print(name, results[name], flush=True)
            continue
        ts = time.time() - t0
        if name not in sqls:
            results[name] = f"no-oracle rows={len(rows)}"
            print(f"{name:28s} {results[name]} ({ts:.1f}s)", flush=True)
            continue
        try:
            dcols, drows = duck_rows(con, sqls[name])
        except Exception as e:  # noqa: BLE001
            results[name] = f"DUCK ERROR {str(e)[:300]}"
            print(name, results[name], flush=True)
            continue
        if cols != dcols:
            results[name] = f"COLUMNS spark={cols} duck={dcols}"
        elif len(rows) != len(drows):
            results[name] = f"ROWS spark={len(rows)} duck={len(drows)}"
        elif rows != drows:
            diff = [(a, b) for a, b in zip(rows, drows) if a != b][:2]
            results[name] = f"VALUES differ, e.g. {diff}"
        else:
            results[name] = f"ok rows={len(rows)}"
        print(f"{name:28s} {results[name]} ({ts:.1f}s)", flush=True)
    return results


if __name__ == "__main__":
    sys.path.insert(0, "/root/repo")
    from fieldstack import get_session
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_session(master="local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    res = check(spark, sf_dir, sys.argv[2:] or None)
    bad = {k: v for k, v in res.items() if not (v.startswith("ok") or v.startswith("no-oracle"))}
    print(f"\n{len(res) - len(bad)}/{len(res)} ok")
    for k, v in bad.items():
        print("FAIL", k, v[:400])
