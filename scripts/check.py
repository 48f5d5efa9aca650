"""Run registered queries against their SQL on DuckDB and compare rows, columns and values.

Usage: python scripts/check.py [--sf /root/testdata/sf0.01] [--skip PREFIX ...] [PREFIX ...]
"""

from __future__ import annotations

import argparse
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from almoner.plans.registry import oracle_sql, queries  # noqa: E402
from almoner.session import get_session  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def norm(value):
    if isinstance(value, bool) or value is None:
        return repr(value)
    if hasattr(value, "isoformat"):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return repr([norm(v) for v in value])
    return repr(value)


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(norm(r[i]) for i in order) for r in rows)


def main() -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("names", nargs="*")
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    parser.add_argument("--skip", nargs="*", default=[])
    args = parser.parse_args()
    spark = get_session("check", "local[8]", spark__sql__shuffle__partitions=8, spark__ui__enabled="false")
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{args.sf}/{name}.parquet'")
    sql, bad = oracle_sql(), 0
    for name, fn in queries().items():
        if args.names and not name.startswith(tuple(args.names)):
            continue
        if name.startswith(tuple(args.skip)):
            continue
        start = time.time()
        try:
            df = fn(spark, args.sf)
            got = table(df.columns, df.collect())
        except Exception as error:  # noqa: BLE001
            bad += 1
            print(f"FAIL {name}: spark: {str(error)[:600]}")
            continue
        spent = time.time() - start
        if name not in sql:
            print(f"rows {name}: {len(got)} rows, {spent:.1f}s")
            continue
        try:
            result = con.execute(sql[name])
            columns = [d[0] for d in result.description]
            want = table(columns, result.fetchall())
        except Exception as error:  # noqa: BLE001
            bad += 1
            print(f"FAIL {name}: sql: {str(error)[:600]}")
            continue
        if sorted(columns) != sorted(df.columns):
            bad += 1
            print(f"FAIL {name}: columns {sorted(df.columns)} != {sorted(columns)}")
        elif got != want:
            bad += 1
            print(f"FAIL {name}: {len(got)} vs {len(want)} rows; {sorted(columns)}")
            diff = [(g, w) for g, w in zip(got, want) if g != w][:2]
            for g, w in diff:
                print("   spark", g, "\n   sql  ", w)
        else:
            print(f"ok   {name}: {len(got)} rows, {spent:.1f}s")
    print("failures:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main())
