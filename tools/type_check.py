"""Compare Spark result types with the DuckDB oracle's column types for every query.

usage: python tools/type_check.py [sf_dir]
"""
from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tessera.registry import ORACLE, QUERIES, load_all  # noqa: E402
from tessera.session import get_session  # noqa: E402
from tessera.testing import duck  # noqa: E402

SPARK_TO_DUCK = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE",
                 "date": "DATE", "boolean": "BOOLEAN", "timestamp": "TIMESTAMP WITH TIME ZONE",
                 "timestamp_ntz": "TIMESTAMP", "float": "FLOAT", "smallint": "SMALLINT"}


def spark_as_duck(t: str) -> str:
    if t.startswith("decimal"):
        return t.upper()
    return SPARK_TO_DUCK.get(t, t)


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    load_all()
    spark = get_session("local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    bad = 0
    for name in sorted(QUERIES):
        if name not in ORACLE:
            continue
        st = {f.name: spark_as_duck(f.dataType.simpleString()) for f in QUERIES[name](spark, sf_dir).schema.fields}
        dt = {r[0]: r[1] for r in con.execute(f"DESCRIBE ({ORACLE[name]})").fetchall()}
        diff = {k: (st.get(k), dt.get(k)) for k in set(st) | set(dt) if st.get(k) != dt.get(k)}
        if diff:
            bad += 1
            print(f"{name}: {diff}", flush=True)
    print("mismatching queries:", bad)


if __name__ == "__main__":
    main()
