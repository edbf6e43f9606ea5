"""Attempt outcomes: last attempt, counters, retry plan, miss log, run summary
(W3, A5, P21, X5, X7, K6, K7).

The source retries in-process (sleep, re-fetch, up to pass 3). Here the attempt log is data:
each pass appends attempt records, and the next pass is *planned* from the log — classified,
with its wait and earliest start — instead of slept through on the driver.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tessera.functions.classify import classify_failure
from tessera.operators.ledger import latest_by_key

PAIR = ["group_id", "obs_date"]
MAX_PASS = 3


def last_attempt(attempts: DataFrame, order_cols=("pass", "attempt_id")) -> DataFrame:
    """The deciding (latest) attempt per pair, by pass then attempt id."""
    return latest_by_key(attempts, PAIR, [F.col(c) for c in order_cols if c in attempts.columns])


def with_class(attempts: DataFrame) -> DataFrame:
    """F8 applied to failed attempts (successful ones get NULL class fields)."""
    c = classify_failure("message")
    fail = ~F.coalesce(F.col("ok"), F.lit(False))
    return attempts.select("*", *[F.when(fail, c[k]).alias(k) for k in ("category", "strategy", "wait_s")])


def actionable(attempts: DataFrame) -> DataFrame:
    """Failed attempts whose strategy is not ``skip``."""
    return with_class(attempts).filter(~F.col("ok") & (F.col("strategy") != "skip"))


def run_outcomes(attempts: DataFrame) -> DataFrame:
    """A5: successes, actionable misses, empty misses and pairs, from the *final* attempt of
    every pair (counts every pair once, whatever pass decided it)."""
    last = with_class(last_attempt(attempts))
    return last.agg(
        F.count(F.lit(1)).alias("pairs"),
        F.count_if(F.col("ok")).alias("successes"),
        F.count_if(~F.col("ok") & (F.col("strategy") != "skip")).alias("misses_actionable"),
        F.count_if(~F.col("ok") & (F.col("strategy") == "skip")).alias("misses_empty"))


def retry_plan(attempts: DataFrame, max_pass: int = MAX_PASS) -> DataFrame:
    """For every pair whose final attempt failed, the next step.

    ``action`` is ``retry`` (with ``next_pass``, ``wait_s`` and ``not_before`` = attempt time +
    wait), ``skip`` for empty payloads, or ``exhausted`` once ``max_pass`` is spent.
    """
    last = with_class(last_attempt(attempts)).filter(~F.col("ok"))
    action = (F.when(F.col("strategy") == "skip", "skip")
              .when(F.col("pass") >= max_pass, "exhausted").otherwise("retry"))
    retry = action == "retry"
    cols = [*PAIR, "pass", "message", "category", "strategy", "wait_s", action.alias("action"),
            F.when(retry, F.col("pass") + 1).alias("next_pass")]
    if "attempted_at" in last.columns:
        cols.append(F.when(retry, F.col("attempted_at") + F.make_interval(secs=F.col("wait_s")))
                    .alias("not_before"))
    return last.select(*cols)


def run_summary(attempts: DataFrame, *, run_ts: str, dry_run: bool = False) -> DataFrame:
    """One-row run summary (counters of A5 plus run identity)."""
    return run_outcomes(attempts).select(
        F.lit(run_ts).alias("run_ts"), "pairs", "successes", "misses_actionable", "misses_empty",
        F.lit(dry_run).alias("dry_run"))


def summary_json(summary: DataFrame, group_ranges: DataFrame | None = None) -> DataFrame:
    """the summary as one JSON document; per-group ranges become a map of structs.

    The map holds one entry per configured group (bounded by the group catalog: hundreds), so
    gathering it into the single summary row is safe; per-group detail at any size stays
    available as rows (``plans.ingest.range_digest``).
    """
    s = summary
    if group_ranges is not None:
        ranges = group_ranges.agg(F.map_from_entries(F.collect_list(F.struct(
            "group_id", F.struct(F.col("n_days").alias("count"), F.col("first_ymd").alias("start"),
                                 F.col("last_ymd").alias("end"))))).alias("group_ranges"))
        s = s.withColumn("group_ranges", ranges.scalar())  # scalar subquery, no join
    # null fields are kept ("start": null for an up-to-date group), as in the source's JSON
    return s.select(F.to_json(F.struct(*s.columns), {"ignoreNullFields": "false"}).alias("summary"))


def write_miss_log(misses: DataFrame, path: str) -> None:
    """K6: append failed attempts as JSON Lines (one line per miss, with its pass)."""
    misses.write.mode("append").json(path)
