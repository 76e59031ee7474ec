"""Run registered Spark queries next to their DuckDB SQL and compare results.

Usage: python tests/oracle_check.py [sf_dir] [name ...]
Rows are compared as sorted, normalised tuples (columns sorted by name).
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return repr(v)
    if isinstance(v, decimal.Decimal):
        return repr(float(v))
    if isinstance(v, (dt.datetime,)):
        return v.isoformat()
    if isinstance(v, dt.date):
        return dt.datetime(v.year, v.month, v.day).isoformat()
    if isinstance(v, bool):
        return str(v)
    return str(v)


def _rows(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_norm(r[i]) for i in order) for r in records]
    out.sort(key=lambda t: tuple("" if x is None else x for x in t))
    return [columns[i] for i in order], out


def duck(sf_dir: str):
    import duckdb

    from shelfwise.sources.testviews import TABLES

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def compare(spark, sf_dir: str, names=None, verbose=True):
    import __spark_entry__ as entry

    qs, sqls = entry.queries(), entry.oracle_sql()
    con = duck(sf_dir)
    results = {}
    for name in names or list(qs):
        t0 = time.time()
        try:
            sdf = qs[name](spark, sf_dir)
            s_cols = sdf.columns
            s_rows = [tuple(r) for r in sdf.collect()]
        except Exception as e:  # noqa: BLE001
            results[name] = ("spark-error", repr(e)[:400])
            if verbose:
                print(f"{name:28s} SPARK ERROR {repr(e)[:400]}", flush=True)
            continue
        t1 = time.time()
        if name not in sqls:
            results[name] = ("rows-only", len(s_rows))
            if verbose:
                print(f"{name:28s} rows={len(s_rows)} (no oracle) {t1 - t0:.1f}s", flush=True)
            continue
        try:
            cur = con.execute(sqls[name])
            d_cols = [d[0] for d in cur.description]
            d_rows = cur.fetchall()
        except Exception as e:  # noqa: BLE001
            results[name] = ("duck-error", repr(e)[:400])
            if verbose:
                print(f"{name:28s} DUCK ERROR {repr(e)[:400]}", flush=True)
            continue
        sc, sr = _rows(s_cols, s_rows)
        dc, dr = _rows(d_cols, d_rows)
        ok = sc == dc and sr == dr
        results[name] = ("ok" if ok else "MISMATCH", len(s_rows), len(d_rows))
        if verbose:
            msg = f"{name:28s} {'ok' if ok else 'MISMATCH'} spark={len(s_rows)} duck={len(d_rows)} {t1 - t0:.1f}s"
            if not ok:
                if sc != dc:
                    msg += f"\n   cols spark={sc}\n   cols duck ={dc}"
                else:
                    a, b = set(sr), set(dr)
                    msg += f"\n   only spark: {list(a - b)[:3]}\n   only duck : {list(b - a)[:3]}"
            print(msg, flush=True)
    return results


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = (SparkSession.builder.master("local[8]")
             .config("spark.ui.enabled", "false")
             .config("spark.sql.shuffle.partitions", "8")
             .config("spark.driver.memory", "8g").config("spark.ui.showConsoleProgress", "false")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    res = compare(spark, sf, sys.argv[2:] or None)
    bad = [k for k, v in res.items() if v[0] not in ("ok", "rows-only")]
    print("FAILED:", bad if bad else "none")
