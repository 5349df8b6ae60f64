"""Run registered queries in Spark and their oracle SQL in DuckDB, compare results.

Usage: python tests/oracle_check.py [sf_dir] [name ...]
Mirrors the driver's check: row count, column names, order-insensitive values.
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 9)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if hasattr(v, "item"):
        return v.item()
    return v


def canon(rows):
    return sorted((tuple(norm(x) for x in r) for r in rows), key=lambda t: tuple((x is None, str(x)) for x in t))


def duck(sf_dir):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def compare(spark, sf_dir, names=None, verbose=True):
    import __spark_entry__ as E

    qs, sqls = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    results = {}
    for name in names or list(qs):
        t0 = time.time()
        try:
            sdf = qs[name](spark, sf_dir)
            scols = sdf.columns
            srows = [tuple(r) for r in sdf.collect()]
        except Exception as e:  # noqa: BLE001
            results[name] = f"SPARK ERROR {type(e).__name__}: {str(e)[:300]}"
            print(name, results[name])
            continue
        el = time.time() - t0
        if name not in sqls:
            results[name] = f"rows-only ({len(srows)} rows)"
            print(f"{name:32s} {el:6.2f}s {results[name]}")
            continue
        try:
            cur = con.execute(sqls[name])
            dcols = [d[0] for d in cur.description]
            drows = cur.fetchall()
        except Exception as e:  # noqa: BLE001
            results[name] = f"DUCK ERROR {type(e).__name__}: {str(e)[:300]}"
            print(name, results[name])
            continue
        si = sorted(range(len(scols)), key=lambda i: scols[i])
        di = sorted(range(len(dcols)), key=lambda i: dcols[i])
        ok_cols = sorted(scols) == sorted(dcols)
        a = canon([tuple(r[i] for i in si) for r in srows])
        b = canon([tuple(r[i] for i in di) for r in drows])
        ok = ok_cols and a == b
        results[name] = "OK" if ok else "MISMATCH"
        print(f"{name:32s} {el:6.2f}s {results[name]} rows={len(srows)}/{len(drows)}" + ("" if ok_cols else f" cols {scols} vs {dcols}"))
        if not ok and verbose:
            sa, sb = set(a), set(b)
            print("  spark-only:", sorted(sa - sb, key=str)[:5])
            print("  duck-only: ", sorted(sb - sa, key=str)[:5])
    return results


if __name__ == "__main__":
    from vitals.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or None
    spark = local_session()
    res = compare(spark, sf, names)
    bad = [k for k, v in res.items() if v not in ("OK",) and not v.startswith("rows-only")]
    print(f"{len(res) - len(bad)}/{len(res)} ok; bad: {bad}")
