"""Run registered queries in Spark and their SQL in DuckDB, compare results.

Usage: python tests/oracle_harness.py [sf_dir] [name ...]
Comparison mirrors the driver: columns sorted by name, rows compared as an
order-insensitive multiset of normalised values.
"""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def _norm(v, approx: bool):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return f"{v:.6g}" if approx else repr(v)
    if isinstance(v, decimal.Decimal):
        return format(v.normalize(), "f") if not approx else f"{float(v):.6g}"
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, (bytes, bytearray, memoryview)):
        return bytes(v).hex()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x, approx) for x in v) + "]"
    if isinstance(v, dict):
        return "{" + ",".join(f"{k}:{_norm(x, approx)}" for k, x in sorted(v.items())) + "}"
    if hasattr(v, "asDict"):
        return _norm(v.asDict(), approx)
    if hasattr(v, "item"):
        return _norm(v.item(), approx)
    return str(v)


def digest(cols, rows, approx=False):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(_norm(r[i], approx) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest(), lines


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def compare(spark, sf_dir, names=None, verbose=True):
    sys.path.insert(0, ".")
    import __spark_entry__ as E

    qs, sql = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    report = {}
    for name in names or sorted(qs):
        t0 = time.time()
        try:
            df = qs[name](spark, sf_dir)
            cols = df.columns
            rows = [tuple(r) for r in df.collect()]
        except Exception as e:  # noqa: BLE001
            report[name] = f"SPARK ERROR {type(e).__name__}: {str(e)[:300]}"
            continue
        ts = time.time() - t0
        if name not in sql:
            report[name] = f"rows-only ({len(rows)} rows, {ts:.1f}s)"
            continue
        try:
            res = con.execute(sql[name])
            dcols = [d[0] for d in res.description]
            drows = res.fetchall()
        except Exception as e:  # noqa: BLE001
            report[name] = f"DUCK ERROR {type(e).__name__}: {str(e)[:300]}"
            continue
        if sorted(cols) != sorted(dcols):
            report[name] = f"COLUMNS differ spark={cols} duck={dcols}"
            continue
        h1, l1 = digest(cols, rows)
        h2, l2 = digest(dcols, drows)
        if h1 == h2:
            report[name] = f"OK exact ({len(rows)} rows, {ts:.1f}s)"
            continue
        a1, _ = digest(cols, rows, True)
        a2, _ = digest(dcols, drows, True)
        status = "APPROX" if a1 == a2 else "MISMATCH"
        s1, s2 = set(l1), set(l2)
        ex = sorted(s1 - s2)[:3], sorted(s2 - s1)[:3]
        report[name] = f"{status} spark={len(rows)} duck={len(drows)} only_spark={ex[0]} only_duck={ex[1]}"
    if verbose:
        for k, v in report.items():
            print(f"{k:32s} {v}")
    return report


if __name__ == "__main__":
    sys.path.insert(0, ".")
    from lakeloom.session import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session(master="local[8]", shuffle_partitions=8,
                          extra_conf={"spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("FATAL")
    compare(spark, sf, sys.argv[2:] or None)
