"""Run every catalog query in Spark and its oracle SQL in DuckDB; compare the results.

Usage: python tools/check_oracle.py [sf_dir] [name ...]
Prints one line per query: rows, schema (names) and exact multiset equality.
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from autolake.plans.catalog import ORACLE, QUERIES  # noqa: E402
from autolake.session import build_session  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        if math.isnan(v):
            return (1, "nan")
        return (1, repr(float(v)))
    if hasattr(v, "isoformat"):
        return (2, v.isoformat())
    if isinstance(v, bool):
        return (3, str(v))
    if isinstance(v, (list, tuple)):
        return (4, repr([norm(x) for x in v]))
    return (5, str(v))


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(norm(r[i]) for i in order) for r in rows)


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    if os.environ.get("CHECK_DEFAULT_SESSION"):
        # a session as a driver would build it: Spark's defaults (200 shuffle partitions)
        from pyspark.sql import SparkSession
        spark = SparkSession.builder.master("local[*]").getOrCreate()
    else:
        spark = build_session(shuffle_partitions=8)
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    bad = 0
    for name in names:
        t0 = time.time()
        try:
            df = QUERIES[name](spark, sf_dir)
            srows = [tuple(r) for r in df.collect()]
            scols = df.columns
        except Exception as e:  # report and continue
            print(f"{name:28s} SPARK ERROR {type(e).__name__}: {str(e)[:300]}")
            bad += 1
            continue
        ts = time.time() - t0
        if name not in ORACLE:
            print(f"{name:28s} rows={len(srows):7d} (no oracle) {ts:.1f}s")
            continue
        try:
            res = con.execute(ORACLE[name])
            dcols = [c[0] for c in res.description]
            drows = res.fetchall()
        except Exception as e:
            print(f"{name:28s} DUCKDB ERROR {str(e)[:300]}")
            bad += 1
            continue
        same_cols = sorted(scols) == sorted(dcols)
        same = same_cols and rows_of(scols, srows) == rows_of(dcols, drows)
        status = "OK " if same else "BAD"
        bad += 0 if same else 1
        print(f"{name:28s} {status} spark={len(srows)} duck={len(drows)} cols={'=' if same_cols else (sorted(scols), sorted(dcols))} {ts:.1f}s")
        if not same and same_cols and len(srows) == len(drows):
            a, b = rows_of(scols, srows), rows_of(dcols, drows)
            diff = [(x, y) for x, y in zip(a, b) if x != y][:2]
            print("    first diffs:", sorted(scols), diff)
    print(f"bad={bad}")
    spark.stop()


if __name__ == "__main__":
    main()
