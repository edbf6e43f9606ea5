"""Ledger and outcome queries: A1, A5, A6, W2, W3, P21, X5, X7, K4, K6, K7, J6, F13."""
from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import ledger, outcomes
from tessera.queries import analogues as A
from tessera.queries.q_functions import CLASSIFY_SQL
from tessera.registry import query
from tessera.schemas import ATTEMPT_SCHEMA
from tessera.session import scratch_dir


@query("a1_pair_stats", A.with_views("v1") + """
SELECT group_id, obs_date, COUNT(*) AS row_count, COUNT(DISTINCT instrument) AS instrument_count,
       COUNT(DISTINCT attribute) AS attribute_count,
       'rows=' || COUNT(*) || ' instruments=' || COUNT(DISTINCT instrument) || ' attributes=' || COUNT(DISTINCT attribute) AS message
FROM v1 GROUP BY group_id, obs_date""")
def pair_stats_q(spark, sf_dir):
    return ledger.pair_stats(A.observations(spark, sf_dir))


@query("a6_distinct_counts", A.with_views("v1") + """
SELECT group_id, COUNT(*) AS n_rows, COUNT(DISTINCT instrument) AS n_instruments,
       COUNT(DISTINCT attribute) AS n_attributes, COUNT(DISTINCT date) AS n_dates
FROM v1 GROUP BY group_id""")
def distinct_counts_q(spark, sf_dir):
    v1 = A.observations(spark, sf_dir)
    return v1.groupBy("group_id").agg(
        F.count(F.lit(1)).alias("n_rows"), F.countDistinct("instrument").alias("n_instruments"),
        F.countDistinct("attribute").alias("n_attributes"), F.countDistinct("date").alias("n_dates"))


SKETCH_ERROR = 0.08         # five standard errors of the sketch


@query("a6_merged_sketches", A.with_views("v1") + """
SELECT group_id, COUNT(*) AS n_rows, COUNT(DISTINCT instrument) AS n_instruments, COUNT(DISTINCT attribute) AS n_attributes,
       true AS instruments_fit, true AS attributes_fit
FROM v1 GROUP BY group_id""")
def merged_sketches_q(spark, sf_dir):
    """Group counts from stored day sketches beside the exact ones, and whether the estimates are within the bound."""
    v1, path = A.observations(spark, sf_dir), scratch_dir(spark, "sketches")
    ledger.pair_sketches(v1).write.parquet(path)
    merged = ledger.merged_counts(spark.read.parquet(path))
    exact = v1.groupBy("group_id").agg(F.countDistinct("instrument").alias("n_instruments"),
                                       F.countDistinct("attribute").alias("n_attributes"))
    fits = lambda e, n: F.abs(F.col(e) - F.col(n)) <= SKETCH_ERROR * F.col(n)
    return merged.join(exact, "group_id").select(
        "group_id", F.col("row_count").alias("n_rows"), "n_instruments", "n_attributes",
        fits("instrument_estimate", "n_instruments").alias("instruments_fit"),
        fits("attribute_estimate", "n_attributes").alias("attributes_fit"))


def _reingested(spark, sf_dir):
    """V1 plus a second ingest one day later whose values carry a ``/v2`` suffix."""
    v1 = A.observations(spark, sf_dir)
    v2 = v1.select("group_id", "instrument", "attribute", "date",
                   F.concat(F.coalesce("value", F.lit("null")), F.lit("/v2")).alias("value"),
                   "obs_date", (F.col("ingested_at") + F.expr("INTERVAL 1 DAY")).alias("ingested_at"))
    return v1.unionByName(v2)


@query("w2_latest_version", A.with_views("v1") + """,
versions AS (SELECT group_id, instrument, attribute, date, value, ingested_at FROM v1
         UNION ALL
         SELECT group_id, instrument, attribute, date, coalesce(value, 'null') || '/v2', ingested_at + INTERVAL 1 DAY FROM v1)
SELECT group_id, instrument, attribute, date, value FROM (
  SELECT *, row_number() OVER (PARTITION BY group_id, instrument, attribute, date
                               ORDER BY ingested_at DESC, value DESC) AS rn FROM versions) WHERE rn = 1""")
def latest_version_q(spark, sf_dir):
    return ledger.latest_observations(_reingested(spark, sf_dir)).select(
        "group_id", "instrument", "attribute", "date", "value")


_LAST_SQL = """last AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY group_id, obs_date ORDER BY pass DESC, attempt_id DESC) AS rn
                 FROM v4) WHERE rn = 1)"""


@query("w3_last_attempt", A.with_views("v4") + ", " + _LAST_SQL + """
SELECT group_id, obs_date, pass, ok, message, attempt_id FROM last""")
def last_attempt_q(spark, sf_dir):
    return outcomes.last_attempt(A.attempts(spark, sf_dir)).select(
        "group_id", "obs_date", "pass", "ok", "message", "attempt_id")


@query("p21_actionable_misses", A.with_views("v4") + f"""
SELECT attempt_id, group_id, obs_date, category, strategy FROM (
  SELECT attempt_id, group_id, obs_date, ok, {CLASSIFY_SQL[0]} AS category, {CLASSIFY_SQL[1]} AS strategy FROM v4)
WHERE NOT ok AND strategy <> 'skip'""")
def actionable_q(spark, sf_dir):
    return outcomes.actionable(A.attempts(spark, sf_dir)).select(
        "attempt_id", "group_id", "obs_date", "category", "strategy")


_OUTCOME_SQL = A.with_views("v4") + ", " + _LAST_SQL + f""",
cls AS (SELECT *, {CLASSIFY_SQL[1]} AS strategy FROM last)"""


@query("a5_run_outcomes", _OUTCOME_SQL + """
SELECT COUNT(*) AS pairs, COUNT(*) FILTER (WHERE ok) AS successes,
       COUNT(*) FILTER (WHERE NOT ok AND strategy <> 'skip') AS misses_actionable,
       COUNT(*) FILTER (WHERE NOT ok AND strategy = 'skip') AS misses_empty FROM cls""")
def outcomes_q(spark, sf_dir):
    return outcomes.run_outcomes(A.attempts(spark, sf_dir))


@query("x7_run_report", _OUTCOME_SQL + f"""
SELECT '{A.RUN_TS}' AS run_ts, COUNT(*) AS pairs, COUNT(*) FILTER (WHERE ok) AS successes,
       COUNT(*) FILTER (WHERE NOT ok AND strategy <> 'skip') AS misses_actionable,
       COUNT(*) FILTER (WHERE NOT ok AND strategy = 'skip') AS misses_empty, false AS dry_run FROM cls""")
def run_report_q(spark, sf_dir):
    return outcomes.run_summary(A.attempts(spark, sf_dir), run_ts=A.RUN_TS)


@query("x5_retry_plan", A.with_views("v4") + ", " + _LAST_SQL + f""",
cls AS (SELECT *, {CLASSIFY_SQL[0]} AS category, {CLASSIFY_SQL[1]} AS strategy, {CLASSIFY_SQL[2]} AS wait_s
        FROM last WHERE NOT ok)
SELECT group_id, obs_date, pass, message, category, strategy, wait_s,
       CASE WHEN strategy = 'skip' THEN 'skip' WHEN pass >= 3 THEN 'exhausted' ELSE 'retry' END AS action,
       CASE WHEN strategy <> 'skip' AND pass < 3 THEN pass + 1 END AS next_pass,
       CASE WHEN strategy <> 'skip' AND pass < 3
            THEN strftime(attempted_at + to_seconds(wait_s), '%Y-%m-%d %H:%M:%S.%f') END AS not_before
FROM cls""")
def retry_plan_q(spark, sf_dir):
    plan = outcomes.retry_plan(A.attempts(spark, sf_dir))
    return plan.withColumn("not_before", F.date_format("not_before", "yyyy-MM-dd HH:mm:ss.SSSSSS"))


@query("k6_miss_log", A.with_views("v4") + """
SELECT group_id, obs_date, ok, message, pass FROM v4 WHERE NOT ok""")
def miss_log_q(spark, sf_dir):
    path = scratch_dir(spark, "misslog")
    misses = A.attempts(spark, sf_dir).filter(~F.col("ok")).select("group_id", "obs_date", "ok", "message", "pass")
    outcomes.write_miss_log(misses.filter(F.col("pass") == 1), path)
    outcomes.write_miss_log(misses.filter(F.col("pass") > 1), path)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ATTEMPT_SCHEMA.fields
                       if f.name in ("group_id", "obs_date", "ok", "message", "pass"))
    return spark.read.schema(schema).json(path)


@query("k7_run_summary", _OUTCOME_SQL + f"""
SELECT to_json({{'run_ts': '{A.RUN_TS}', 'pairs': COUNT(*), 'successes': COUNT(*) FILTER (WHERE ok),
        'misses_actionable': COUNT(*) FILTER (WHERE NOT ok AND strategy <> 'skip'),
        'misses_empty': COUNT(*) FILTER (WHERE NOT ok AND strategy = 'skip'), 'dry_run': false}})::VARCHAR AS summary
FROM cls""")
def summary_q(spark, sf_dir):
    return outcomes.summary_json(outcomes.run_summary(A.attempts(spark, sf_dir), run_ts=A.RUN_TS))


def _new_manifest_rows(spark, sf_dir):
    """A later run re-ingests every pair from the 20th on: one more row, status ok, newer time."""
    m = A.manifest(spark, sf_dir)
    return (m.filter(F.dayofmonth("obs_date") >= 20)
            .select("group_id", "obs_date", (F.col("row_count") + 1).alias("row_count"),
                    "instrument_count", "attribute_count", F.lit("ok").alias("status"),
                    F.concat(F.col("volume_path"), F.lit(".v2")).alias("volume_path"),
                    (F.col("ingested_at") + F.expr("INTERVAL 1 DAY")).alias("ingested_at")))


_K4_SQL = A.with_views("v2") + """,
new AS (SELECT group_id, obs_date, row_count + 1 AS row_count, instrument_count, attribute_count,
               'ok' AS status, volume_path || '.v2' AS volume_path, ingested_at + INTERVAL 1 DAY AS ingested_at
        FROM v2 WHERE day(obs_date) >= 20)
SELECT group_id, obs_date, row_count, status, volume_path FROM v2
WHERE NOT EXISTS (SELECT 1 FROM new WHERE new.group_id = v2.group_id AND new.obs_date = v2.obs_date)
UNION ALL SELECT group_id, obs_date, row_count, status, volume_path FROM new"""


@query("j6_manifest_replace", _K4_SQL)
def replace_q(spark, sf_dir):
    old = A.manifest(spark, sf_dir)
    return ledger.replace_keys(old, _new_manifest_rows(spark, sf_dir)).select(
        "group_id", "obs_date", "row_count", "status", "volume_path")


@query("k4_manifest_upsert", _K4_SQL)
def upsert_q(spark, sf_dir):
    """Append-only upsert: both runs append to the manifest folder; readers take the current
    row per key (newest ``ingested_at``)."""
    from tessera.sinks.manifest import append_manifest, read_current_manifest
    path = scratch_dir(spark, "manifest")
    append_manifest(A.manifest(spark, sf_dir), path)
    append_manifest(_new_manifest_rows(spark, sf_dir), path)
    return read_current_manifest(spark, path).select("group_id", "obs_date", "row_count", "status", "volume_path")


@query("k4_folded_manifest", _K4_SQL)
def folded_q(spark, sf_dir):
    """The same upsert through a snapshot: the first run is folded, the second is the tail."""
    from tessera.sinks.manifest import append_manifest, fold_manifest, read_current_manifest
    path = scratch_dir(spark, "manifest")
    append_manifest(A.manifest(spark, sf_dir), path, "R1")
    fold_manifest(spark, path)
    append_manifest(_new_manifest_rows(spark, sf_dir), path, "R2")
    return read_current_manifest(spark, path).select("group_id", "obs_date", "row_count", "status", "volume_path")
