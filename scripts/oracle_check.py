"""Run catalog queries on Spark and their SQL on DuckDB and compare
(row count, column names, order-insensitive values).

    python scripts/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return v if os.environ.get("ORACLE_EXACT") == "1" else round(v, 9)
    if hasattr(v, "isoformat"):
        return str(v)[:26]
    return v


def rows_of(records):
    return sorted((tuple(norm(x) for x in r) for r in records), key=lambda t: repr(t))


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    from churnscope.plans.catalog import ORACLE, QUERIES
    if os.environ.get("ORACLE_PLAIN") == "1":
        # a session with Spark's defaults, as an outside driver would build it
        from pyspark.sql import SparkSession
        spark = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
                 .getOrCreate())
    else:
        from churnscope.session import get_spark
        spark = get_spark("local[8]", 8)
    con = duckdb.connect()
    for t in TABLES:
        if os.path.exists(f"{sf}/{t}.parquet"):
            con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    bad = 0
    for name in names or list(QUERIES):
        t0 = time.time()
        try:
            df = QUERIES[name](spark, sf)
            cols = df.columns
            srows = [tuple(r) for r in df.collect()]
        except Exception as e:  # noqa: BLE001
            print(f"{name:32s} SPARK ERROR {type(e).__name__}: {str(e)[:300]}")
            bad += 1
            continue
        ts = time.time() - t0
        if name not in ORACLE:
            print(f"{name:32s} rows={len(srows):7d} (no oracle) {ts:6.1f}s")
            continue
        try:
            rel = con.sql(ORACLE[name])
            ocols = rel.columns
            orows = rel.fetchall()
        except Exception as e:  # noqa: BLE001
            print(f"{name:32s} SQL ERROR {str(e)[:300]}")
            bad += 1
            continue
        ok_cols = sorted(cols) == sorted(ocols)
        if ok_cols:
            idx = [ocols.index(c) for c in cols]
            orows = [tuple(r[i] for i in idx) for r in orows]
        a, b = rows_of(srows), rows_of(orows)
        same = ok_cols and a == b
        status = "OK " if same else "BAD"
        bad += 0 if same else 1
        print(f"{name:32s} {status} rows={len(srows):7d}/{len(orows):7d} {ts:6.1f}s")
        if not same:
            if not ok_cols:
                print("   columns", cols, ocols)
            else:
                diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
                for x, y in diff:
                    print("   spark ", x)
                    print("   oracle", y)
    print("mismatches:", bad)


if __name__ == "__main__":
    main()
