"""Benchmark: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; print one JSON line.

Each query is executed in full through Spark's ``noop`` sink (the whole plan runs, nothing is
shipped to the driver). Every timed query first runs once on the smallest tables
($BENCH_WARMUP_DIR, default sf0.001) so JIT and code-generation warm-up is not charged to the
measurement; the timed run then works on different (larger) data. A query that needs landed pages
or raw files writes its own (nothing is shared between queries), so its time includes landing;
``landing`` times that part alone, outside the total. Set BENCH_ALL=1 to time every registered query, BENCH_WARMUP_DIR= (empty) to disable the warm-up.
"""
from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "x2_backfill_plan", "x3_incremental_plan", "a1_pair_stats", "w2_latest_version",
    "w3_last_attempt", "x5_retry_plan", "p1_flatten_strict", "x1_group_day_extract",
    "j1_series_semi", "x9_all_tiers", "x4_process_pairs", "k2_exactly_once_load",
    "r1_monthly_last_business",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from tessera.registry import QUERIES, load_all
    from tessera.session import get_session

    extra = {"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")}
    spark = get_session(f"local[{cpus}]", app="tessera-bench", shuffle_partitions=int(cpus) * 2,
                        extra=extra)
    spark.sparkContext.setLogLevel("ERROR")
    from tessera.session import checkpoint_root
    checkpoint_root(spark)          # the session's shared folder, or a local one when unset
    load_all()
    names = list(QUERIES) if os.environ.get("BENCH_ALL") else HEADLINE
    warm_dir = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    if warm_dir and os.path.isdir(warm_dir) and os.path.abspath(warm_dir) != os.path.abspath(sf_dir):
        for name in names:
            QUERIES[name](spark, warm_dir).write.format("noop").mode("overwrite").save()
    timings = {}
    for name in names:
        t0 = time.time()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        timings[name] = round(time.time() - t0, 3)
    from tessera.queries.q_flatten import land_observation_pages, land_price_pages
    landing = {}
    for name, land in (("observation_pages", land_observation_pages), ("price_pages", land_price_pages)):
        t0 = time.time()
        land(spark, sf_dir)
        landing[name] = round(time.time() - t0, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_total_wall", "value": round(sum(timings.values()), 3),
                      "unit": "sec", "queries": timings, "sf": sf, "cpus": int(cpus), "landing": landing}))
    spark.stop()


if __name__ == "__main__":
    main()
