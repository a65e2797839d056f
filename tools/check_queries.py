"""Run registered queries next to their SQL in DuckDB and compare rows, columns and values.

    python tools/check_queries.py [--sf 0.01] [name ...]
"""

from __future__ import annotations

import argparse
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
from corpus_engine.catalog import load
from corpus_engine.session import build_session

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def plain(value):
    if isinstance(value, dict):
        return tuple(plain(v) for v in value.values())
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    if hasattr(value, "asDict"):
        return tuple(plain(v) for v in value)
    if value.__class__.__name__ == "Decimal":
        return float(value)
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr(tuple(plain(r[i]) for i in order)) for r in rows)


def main() -> int:
    args = argparse.ArgumentParser()
    args.add_argument("--sf", default="0.01")
    args.add_argument("names", nargs="*")
    opts = args.parse_args()
    folder = f"/root/testdata/sf{opts.sf}"
    spark = build_session(
        "check", f"local[{os.environ.get('BENCH_CPUS', '8')}]",
        spark__sql__shuffle__partitions="8", spark__driver__memory="12g", spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    failed = 0
    for name, query in load().items():
        if opts.names and name not in opts.names:
            continue
        start = time.time()
        try:
            got = query.run(spark, folder)
            rows = got.collect()
            took = time.time() - start
            if query.sql is None:
                print(f"rows  {name:32s} {len(rows):7d} rows {took:6.2f}s", flush=True)
                continue
            start = time.time()
            cur = db.execute(query.sql)
            names = [d[0] for d in cur.description]
            types = {d[0]: str(d[1]) for d in cur.description}
            want = cur.fetchall()
            sql_took = time.time() - start
            mine, theirs = rows_of(got.columns, rows), rows_of(names, want)
            same = sorted(got.columns) == sorted(names) and mine == theirs
            print(f"{'ok   ' if same else 'DIFF '} {name:32s} {len(rows):7d} rows {took:6.2f}s  sql {sql_took:5.2f}s", flush=True)
            if not same:
                failed += 1
                print("   columns", sorted(got.columns), sorted(names), len(rows), len(want))
                print("   types", dict(got.dtypes), types)
                only = [r for r in mine if r not in set(theirs)][:3]
                other = [r for r in theirs if r not in set(mine)][:3]
                print("   spark only", [r[:400] for r in only])
                print("   sql only  ", [r[:400] for r in other])
        except Exception as error:
            failed += 1
            print(f"ERROR {name}: {type(error).__name__}: {str(error)[:1500]}", flush=True)
    print("failed:", failed)
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
