"""Run registered queries in Spark and their oracle SQL in DuckDB; compare.

usage: python tests/oracle_check.py [sf_dir] [name-substring ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from parcela.session import get_spark  # noqa: E402
from parcela.sources.tables import TEST_TABLES  # noqa: E402


def norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 4)
    if hasattr(v, "item"):
        return norm(v.item())
    return v


def rows_of(records):
    return sorted((tuple(norm(x) for x in r) for r in records), key=lambda r: tuple((x is None, str(x)) for x in r))


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    pats = sys.argv[2:]
    import __spark_entry__ as E
    spark = get_spark("local[8]", 8)
    con = duckdb.connect()
    for t in TEST_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    Q, S = E.queries(), E.oracle_sql()
    bad = 0
    for name, fn in Q.items():
        if pats and not any(p in name for p in pats):
            continue
        t0 = time.time()
        try:
            df = fn(spark, sf)
            cols = df.columns
            srows = [tuple(r) for r in df.collect()]
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: spark error {type(e).__name__}: {str(e)[:400]}")
            bad += 1
            continue
        ts = time.time() - t0
        if name not in S:
            print(f"----  {name}: rows={len(srows)} (no oracle) {ts:.1f}s")
            continue
        try:
            rel = con.sql(S[name])
            dcols = rel.columns
            drows = rel.fetchall()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: duckdb error {str(e)[:400]}")
            bad += 1
            continue
        if sorted(cols) != sorted(dcols):
            print(f"FAIL {name}: columns differ\n  spark={cols}\n  duck ={dcols}")
            bad += 1
            continue
        idx = [dcols.index(c) for c in cols]
        drows = [tuple(r[i] for i in idx) for r in drows]
        a, b = rows_of(srows), rows_of(drows)
        if a != b:
            bad += 1
            print(f"FAIL {name}: rows spark={len(a)} duck={len(b)}")
            sa, sb = set(a), set(b)
            print("  only spark:", [r for r in a if r not in sb][:3])
            print("  only duck :", [r for r in b if r not in sa][:3])
        else:
            print(f"ok    {name}: rows={len(a)} {ts:.1f}s")
    print(f"done, {bad} failing")


if __name__ == "__main__":
    main()
