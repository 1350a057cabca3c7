"""Run registered Spark queries against their DuckDB oracle SQL.

Usage: python tests/oracle_check.py [sf_dir] [name ...]
Mirrors the driver's check: column names sorted, row count, and an
order-insensitive comparison of normalised values.
"""

from __future__ import annotations

import math
import os
import sys
import time
from collections import Counter

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

import duckdb  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6) + 0.0
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, norm(x)) for k, x in v.items()))
    if isinstance(v, (bytes, bytearray, memoryview)):
        return bytes(v)
    if hasattr(v, "asDict"):
        return norm(v.asDict(recursive=True))
    return v


def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    scols = sdf.columns
    srows = sdf.collect()
    ts = time.time() - t0
    rel = con.sql(sql)
    dcols = rel.columns
    drows = rel.fetchall()
    ok_cols = sorted(scols) == sorted(dcols)
    res = {"name": name, "spark_rows": len(srows), "duck_rows": len(drows),
           "cols_ok": ok_cols, "sec": round(ts, 2)}
    if ok_cols:
        order = sorted(scols)
        si = [scols.index(c) for c in order]
        di = [dcols.index(c) for c in order]
        a = Counter(tuple(norm(r[i]) for i in si) for r in srows)
        b = Counter(tuple(norm(r[i]) for i in di) for r in drows)
        res["values_ok"] = a == b
        if a != b:
            only_s = list((a - b).elements())[:3]
            only_d = list((b - a).elements())[:3]
            res["only_spark"] = only_s
            res["only_duck"] = only_d
    else:
        res["spark_cols"], res["duck_cols"] = scols, dcols
    return res


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    import __spark_entry__ as E
    from quarry.session import get_spark
    spark = get_spark(shuffle_partitions=8)
    qs, orc = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for name in (names or list(qs)):
        if name not in orc:
            df = qs[name](spark, sf_dir)
            n = df.count()
            print(f"{name}: rows-only {n}", flush=True)
            continue
        try:
            r = compare(spark, con, name, qs[name], orc[name], sf_dir)
        except Exception as e:  # report and continue
            r = {"name": name, "error": repr(e)[:2000]}
        ok = r.get("values_ok") and r.get("spark_rows") == r.get("duck_rows")
        bad += 0 if ok else 1
        print(("OK  " if ok else "BAD ") + str(r), flush=True)
    print(f"{bad} mismatches")


if __name__ == "__main__":
    main()
