"""Run registered queries in Spark and their DuckDB oracle, compare rows.

    python tests/oracle_check.py [sf_dir] [name ...]

Prints one line per query: rows on both sides, whether the sorted rows agree,
and the Spark time. Values are compared after normalising arrays and structs
to Python lists / tuples.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def norm(v):
    if isinstance(v, dict):
        return tuple(norm(x) for x in v.values())
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if hasattr(v, "asDict"):
        return tuple(norm(x) for x in v)
    return v


def canon(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(norm(r[i]) for i in order) for r in rows), key=repr)


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    import __spark_entry__ as entry
    from arbor.plans.session import local_session

    spark = local_session(cpus=8)
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    qs, oracle = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in names or list(qs):
        t0 = time.time()
        df = qs[name](spark, sf)
        rows = df.collect()
        dt = time.time() - t0
        cols = df.columns
        if name not in oracle:
            print(f"{name:24s} spark={len(rows):7d} (no oracle) {dt:6.2f}s")
            continue
        res = con.execute(oracle[name])
        ocols = [d[0] for d in res.description]
        orows = res.fetchall()
        ok = sorted(cols) == sorted(ocols) and canon([tuple(r) for r in rows], cols) == canon(orows, ocols)
        bad += not ok
        print(f"{name:24s} spark={len(rows):7d} duck={len(orows):7d} {'OK ' if ok else 'BAD'} {dt:6.2f}s"
              + ("" if sorted(cols) == sorted(ocols) else f" cols {cols} vs {ocols}"))
        if not ok and os.environ.get("SHOW"):
            a, b = canon([tuple(r) for r in rows], cols), canon(orows, ocols)
            print("  spark:", json.dumps([repr(x) for x in a[:3]]))
            print("  duck: ", json.dumps([repr(x) for x in b[:3]]))
    spark.stop()
    sys.exit(1 if bad else 0)


if __name__ == "__main__":
    main()
