"""Run registered queries on Spark and their DuckDB oracles side by side; compare results.

usage: python tools/oracle_check.py [sf_dir] [name-substring ...]
"""
from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tessera.registry import ORACLE, QUERIES, load_all  # noqa: E402
from tessera.session import get_session  # noqa: E402

from tessera.testing import canon, duck  # noqa: E402


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    pats = sys.argv[2:]
    load_all()
    spark = get_session("local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    results = {}
    for name, fn in QUERIES.items():
        if pats and not any(p in name for p in pats):
            continue
        t0 = time.time()
        try:
            df = fn(spark, sf_dir)
            cols = df.columns
            rows = [tuple(r) for r in df.collect()]
        except Exception as e:  # noqa: BLE001
            results[name] = "SPARK-ERROR " + str(e).splitlines()[0][:300]
            print(name, results[name], flush=True)
            continue
        ts = time.time() - t0
        sql = ORACLE.get(name)
        if sql is None:
            results[name] = f"rows-only n={len(rows)}"
            print(f"{name:40s} {results[name]} {ts:.1f}s", flush=True)
            continue
        try:
            res = con.execute(sql)
            ocols = [d[0] for d in res.description]
            orows = res.fetchall()
        except Exception as e:  # noqa: BLE001
            results[name] = "DUCK-ERROR " + str(e).splitlines()[0][:300]
            print(name, results[name], flush=True)
            continue
        a, b = canon(cols, rows), canon(ocols, orows)
        if a[0] != b[0]:
            status = f"COLS spark={a[0]} duck={b[0]}"
        elif len(a[1]) != len(b[1]):
            status = f"COUNT spark={len(a[1])} duck={len(b[1])}"
        elif a[1] != b[1]:
            diff = [(x, y) for x, y in zip(a[1], b[1]) if x != y][:2]
            status = f"VALUES {diff}"
        else:
            status = f"OK n={len(rows)}"
        results[name] = status
        print(f"{name:40s} {status[:400]} {ts:.1f}s", flush=True)
    bad = [k for k, v in results.items() if not (v.startswith("OK") or v.startswith("rows-only"))]
    print(json.dumps({"total": len(results), "bad": bad}))


if __name__ == "__main__":
    main()
