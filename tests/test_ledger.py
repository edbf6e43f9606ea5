import datetime as dt
import random

from pyspark.sql import functions as F

from tessera.operators import ledger, outcomes


def test_latest_by_key_with_hot_key(spark):
    rnd = random.Random(7)
    rows = []
    for i in range(3000):
        k = "hot" if i % 3 == 0 else f"k{rnd.randrange(200)}"   # one key holds a third of the rows
        rows.append((k, rnd.randrange(10_000), f"v{i}"))
    df = spark.createDataFrame(rows, "k string, ts long, v string")
    got = {r.k: (r.ts, r.v) for r in ledger.latest_by_key(df, ["k"], [F.col("ts"), F.col("v")]).collect()}
    brute = {}
    for k, ts, v in rows:
        if k not in brute or (ts, v) > brute[k]:
            brute[k] = (ts, v)
    assert got == brute


def test_replace_keys_and_stats(spark):
    old = spark.createDataFrame([("A", 1, "x"), ("B", 1, "y")], "group_id string, obs_date int, v string")
    new = spark.createDataFrame([("B", 1, "z")], "group_id string, obs_date int, v string")
    got = sorted(tuple(r) for r in ledger.replace_keys(old, new).collect())
    assert got == [("A", 1, "x"), ("B", 1, "z")]
    obs = spark.createDataFrame([("G", 1, "i1", "a"), ("G", 1, "i1", "b"), ("G", 1, "i2", "a")],
                                "group_id string, obs_date int, instrument string, attribute string")
    r = ledger.pair_stats(obs).first()
    assert (r.row_count, r.instrument_count, r.attribute_count, r.message) == (
        3, 2, 2, "rows=3 instruments=2 attributes=2")


def test_retry_plan_and_outcomes(spark):
    t = dt.datetime(2024, 1, 1)
    att = spark.createDataFrame([
        ("A", "20240101", False, "429 too many requests", 1, 1, t),
        ("A", "20240101", True, "rows=1 instruments=1 attributes=1", 2, 2, t),   # recovered
        ("B", "20240101", False, "timed out", 1, 3, t),
        ("B", "20240101", False, "timed out", 2, 4, t),                           # next: pass 3
        ("C", "20240101", False, "204 no content", 1, 5, t),                      # skip
        ("D", "20240101", False, "boom", 3, 6, t),                                # exhausted
    ], "group_id string, obs_date string, ok boolean, message string, pass int, attempt_id long, attempted_at timestamp")
    plan = {r.group_id: r for r in outcomes.retry_plan(att).collect()}
    assert set(plan) == {"B", "C", "D"}
    assert (plan["B"].action, plan["B"].next_pass, plan["B"].wait_s) == ("retry", 3, 90)
    assert plan["B"].not_before == t + dt.timedelta(seconds=90)
    assert plan["C"].action == "skip" and plan["D"].action == "exhausted"
    o = outcomes.run_outcomes(att).first()
    assert (o.pairs, o.successes, o.misses_actionable, o.misses_empty) == (4, 1, 2, 1)


def test_summary_json_with_group_ranges(spark):
    import json
    att = spark.createDataFrame([("A", "20240102", True, "rows=1 instruments=1 attributes=1", 1, 1)],
                                "group_id string, obs_date string, ok boolean, message string, pass int, attempt_id long")
    ranges = spark.createDataFrame([("A", 2, "20240101", "20240102"), ("B", 0, None, None)],
                                   "group_id string, n_days long, first_ymd string, last_ymd string")
    doc = json.loads(outcomes.summary_json(outcomes.run_summary(att, run_ts="T"), ranges).first()["summary"])
    assert doc["successes"] == 1 and doc["group_ranges"]["A"] == {"count": 2, "start": "20240101", "end": "20240102"}
    assert doc["group_ranges"]["B"] == {"count": 0, "start": None, "end": None}
