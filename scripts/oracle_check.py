"""Run registered queries on Spark and their SQL twins on DuckDB; compare.

Usage: python scripts/oracle_check.py [sf_dir] [name ...]
Compares row count, column names and order-insensitive row values (floats
rounded to 6 places). Prints one line per query and a summary.
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from laborlens.catalog.registry import load_all  # noqa: E402
from laborlens.session import get_spark  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if hasattr(v, "isoformat"):
        return str(v)
    return v


def rows_of(records):
    return sorted((tuple(norm(x) for x in r) for r in records), key=lambda t: tuple((x is None, str(x)) for x in t))


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = set(sys.argv[2:])
    reg = load_all()
    spark = get_spark("local[8]", 8)
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    ok = bad = 0
    for name, e in reg.items():
        if only and name not in only:
            continue
        t0 = time.time()
        try:
            df = e.run(spark, sf_dir)
            cols = df.columns
            srows = [tuple(r) for r in df.collect()]
            ts = time.time() - t0
            if e.sql is None:
                print(f"{name:34s} rows={len(srows):7d} spark={ts:6.1f}s  (no SQL twin)")
                ok += 1
                continue
            res = con.execute(e.sql())
            dcols = [d[0] for d in res.description]
            drows = res.fetchall()
            same_cols = sorted(cols) == sorted(dcols)
            if same_cols:
                idx = [dcols.index(c) for c in cols]
                drows = [tuple(r[i] for i in idx) for r in drows]
            a, b = rows_of(srows), rows_of(drows)
            good = same_cols and a == b
            ok += good
            bad += not good
            msg = "OK " if good else "BAD"
            print(f"{name:34s} {msg} rows={len(srows):7d}/{len(drows):7d} spark={ts:6.1f}s")
            if not good:
                if not same_cols:
                    print("   cols spark:", cols, "\n   cols sql:  ", dcols)
                else:
                    sa, sb = set(a), set(b)
                    print("   only spark:", list(sa - sb)[:3])
                    print("   only sql:  ", list(sb - sa)[:3])
        except Exception as ex:  # report and continue
            bad += 1
            print(f"{name:34s} ERR {type(ex).__name__}: {str(ex)[:400]}")
    print(f"summary ok={ok} bad={bad}")


if __name__ == "__main__":
    main()
