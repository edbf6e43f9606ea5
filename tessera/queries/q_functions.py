"""Scalar-function queries over every event."""
from __future__ import annotations

from pyspark.sql import functions as F

from tessera import functions as TF
from tessera.queries import analogues as A
from tessera.queries.common import SPAN_SQL, event_span
from tessera.registry import query
from tessera.session import read_table


def _events(spark, sf_dir):
    return read_table(spark, sf_dir, "events")


@query("f1_business_days", f"""WITH {SPAN_SQL}
SELECT CAST(x AS DATE) AS obs_date, strftime(x, '%Y%m%d') AS ymd FROM span,
generate_series(CAST(span.s AS TIMESTAMP), CAST(span.e AS TIMESTAMP), INTERVAL 1 DAY) g(x)
WHERE isodow(x) < 6""")
def business_days_q(spark, sf_dir):
    start, end = event_span(spark, sf_dir)
    # The span is a pair of scalar subqueries over events; the days are generated from them.
    one = spark.range(1)
    return TF.explode_business_days(one, start, end).select("obs_date", TF.compact("obs_date").alias("ymd"))


@query("f2_yesterday", """
SELECT event_id, strftime(CAST(ts AS DATE) - INTERVAL 1 DAY, '%Y%m%d') AS yesterday FROM events""")
def yesterday_q(spark, sf_dir):
    return _events(spark, sf_dir).select("event_id", TF.yesterday(F.to_date("ts")).alias("yesterday"))


@query("f3_ymd_to_iso", """
SELECT event_id, strftime(ts, '%Y%m%d') AS ymd, strftime(ts, '%Y-%m-%d') AS iso FROM events""")
def ymd_to_iso_q(spark, sf_dir):
    ev = _events(spark, sf_dir).select("event_id", F.date_format("ts", "yyyyMMdd").alias("ymd"))
    return ev.select("event_id", "ymd", TF.ymd_to_iso("ymd").alias("iso"))


@query("f4_iso_to_compact", """
SELECT event_id, strftime(ts, '%Y-%m-%d') AS iso, strftime(ts, '%Y%m%d') AS ymd FROM events""")
def iso_to_compact_q(spark, sf_dir):
    ev = _events(spark, sf_dir).select("event_id", F.date_format("ts", "yyyy-MM-dd").alias("iso"))
    return ev.select("event_id", "iso", TF.iso_to_compact("iso").alias("ymd"))


@query("f5_months_back", """
SELECT event_id, strftime(ts, '%Y%m%d') AS end_ymd, CAST(event_id % 25 AS INTEGER) AS months,
       strftime(date_trunc('month', CAST(ts AS DATE)) - to_months(CAST(event_id % 25 AS INTEGER)), '%Y%m%d') AS start_ymd
FROM events""")
def months_back_q(spark, sf_dir):
    ev = _events(spark, sf_dir).select("event_id", F.date_format("ts", "yyyyMMdd").alias("end_ymd"),
                                       (F.col("event_id") % 25).cast("int").alias("months"))
    return ev.select("event_id", "end_ymd", "months", TF.months_back("end_ymd", F.col("months")).alias("start_ymd"))


@query("f6_next_and_default_start", """
SELECT event_id, strftime(CAST(ts AS DATE) + INTERVAL 1 DAY, '%Y%m%d') AS next_ymd,
       strftime(CAST(ts AS DATE) - INTERVAL 730 DAY, '%Y%m%d') AS default_start_ymd FROM events""")
def next_default_q(spark, sf_dir):
    ev = _events(spark, sf_dir).select("event_id", F.to_date("ts").alias("d"))
    return ev.select("event_id", TF.next_day(TF.compact("d")).alias("next_ymd"),
                     TF.default_start("d").alias("default_start_ymd"))


@query("f7_raw_path", A.with_views("v1") + f"""
SELECT event_id, p AS volume_path,
       regexp_extract(p, '/([^/]+)/[^/]+$', 1) AS dir_group,
       group_id AS parsed_group, ymd AS parsed_obs_date, '{A.RUN_TS}' AS parsed_ts
FROM (SELECT event_id, group_id, strftime(date, '%Y%m%d') AS ymd,
             'raw/' || group_id || '/obs__' || group_id || '__' || strftime(date, '%Y%m%d') || '__{A.RUN_TS}.parquet' AS p
      FROM v1)""")
def raw_path_q(spark, sf_dir):
    v1 = A.observations(spark, sf_dir, helpers=True)
    p = TF.build_raw_path("raw/", F.col("group_id"), TF.compact("date"), A.RUN_TS)
    x = v1.select("event_id", p.alias("volume_path"))
    parsed = TF.parse_raw_path("volume_path")
    return x.select("event_id", "volume_path",
                    F.regexp_extract("volume_path", "/([^/]+)/[^/]+$", 1).alias("dir_group"),
                    parsed["group_id"].alias("parsed_group"), parsed["obs_date"].alias("parsed_obs_date"),
                    parsed["download_ts"].alias("parsed_ts"))


def _classify_sql(msg: str) -> tuple[str, str, str]:
    """DuckDB expressions (category, strategy, wait_s), written out by hand: the expected rules are
    stated here a second time, not taken from the implementation's table."""
    m = f"lower(coalesce({msg}, ''))"
    rate = f"regexp_matches({m}, '429|rate limit|too many requests|quota')"
    auth = f"regexp_matches({m}, '401|403|unauthor|invalid_token|token expired')"
    empty = f"regexp_matches({m}, '204|no content|empty|0 rows')"
    slow = f"regexp_matches({m}, 'timeouterror|timed out|timeout|connection reset|ssl')"
    invalid = f"regexp_matches({m}, 'validation')"
    category = (f"CASE WHEN {rate} THEN 'rate_limit' WHEN {auth} THEN 'auth_error' WHEN {empty} THEN 'empty_payload' "
                f"WHEN {slow} THEN 'timeout' WHEN {invalid} THEN 'validation_failed' ELSE 'unknown' END")
    strategy = (f"CASE WHEN {rate} THEN 'long_backoff' WHEN {auth} THEN 'sleep_and_retry' WHEN {empty} THEN 'skip' "
                f"WHEN {slow} THEN 'long_backoff' WHEN {invalid} THEN 'retry' ELSE 'std_backoff' END")
    wait = f"CASE WHEN {rate} THEN 180 WHEN {auth} THEN 60 WHEN {empty} THEN 0 WHEN {slow} THEN 90 WHEN {invalid} THEN 15 ELSE 30 END"
    return category, strategy, f"CAST({wait} AS INTEGER)"


CLASSIFY_SQL = _classify_sql("message")


@query("f8_classify_failure", A.with_views("v4") + f"""
SELECT attempt_id, message, {CLASSIFY_SQL[0]} AS category, {CLASSIFY_SQL[1]} AS strategy,
       {CLASSIFY_SQL[2]} AS wait_s FROM v4""")
def classify_q(spark, sf_dir):
    v4 = A.attempts(spark, sf_dir)
    c = TF.classify_failure("message")
    return v4.select("attempt_id", "message", c["category"].alias("category"),
                     c["strategy"].alias("strategy"), c["wait_s"].alias("wait_s"))


@query("f9_is_no_content", A.with_views("v4") + """
SELECT attempt_id, (contains(lower(coalesce(message, '')), 'field required') AND contains(lower(coalesce(message, '')), 'instruments'))
       OR contains(lower(coalesce(message, '')), 'no content') OR contains(lower(coalesce(message, '')), '''204''')
       OR contains(lower(coalesce(message, '')), 'code'': ''204''') AS no_content,
       contains(lower(coalesce(message, '')), '204') AS mentions_204
FROM v4""")
def no_content_q(spark, sf_dir):
    v4 = A.attempts(spark, sf_dir)
    return v4.select("attempt_id", TF.is_no_content("message").alias("no_content"),
                     F.lower(F.coalesce("message", F.lit(""))).contains("204").alias("mentions_204"))


@query("f10_stats_message", A.with_views("v1") + """
SELECT group_id, obs_date, 'rows=' || COUNT(*) || ' instruments=' || COUNT(DISTINCT instrument)
       || ' attributes=' || COUNT(DISTINCT attribute) AS message
FROM v1 GROUP BY group_id, obs_date""")
def stats_message_q(spark, sf_dir):
    from tessera.operators.ledger import pair_stats
    return pair_stats(A.observations(spark, sf_dir)).select("group_id", "obs_date", "message")


@query("f11_run_ts_text", """SELECT event_id, strftime(ts, '%Y%m%dT%H%M%S') AS run_ts FROM events""")
def run_ts_q(spark, sf_dir):
    return _events(spark, sf_dir).select("event_id", TF.run_ts_text("ts").alias("run_ts"))


# P5 inputs: three candidates with NULLs and blanks spread over the events.
_P5_A = "CASE WHEN event_id % 5 = 0 THEN NULL WHEN event_id % 5 = 1 THEN '  ' WHEN event_id % 5 = 2 THEN chr(9) ELSE event_type END"
_P5_B = "CASE WHEN event_id % 7 = 0 THEN '' WHEN event_id % 7 = 1 THEN NULL ELSE 'U' || CAST(user_id AS VARCHAR) END"


@query("p5_first_present", f"""
SELECT event_id, a, b,
       CASE WHEN trim(a, ' ' || chr(9) || chr(10) || chr(13) || chr(11) || chr(12)) <> '' THEN a
            WHEN trim(b, ' ' || chr(9) || chr(10) || chr(13) || chr(11) || chr(12)) <> '' THEN b
            ELSE 'UNKNOWN' END AS picked,
       CASE WHEN a <> '' THEN a WHEN b <> '' THEN b ELSE 'UNKNOWN' END AS picked_light
FROM (SELECT event_id, {_P5_A} AS a, {_P5_B} AS b FROM events)""")
def first_present_q(spark, sf_dir):
    e = F.col("event_id")
    a = (F.when(e % 5 == 0, F.lit(None).cast("string")).when(e % 5 == 1, F.lit("  "))
         .when(e % 5 == 2, F.lit("\t")).otherwise(F.col("event_type")))
    b = (F.when(e % 7 == 0, F.lit("")).when(e % 7 == 1, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("U"), F.col("user_id").cast("string"))))
    x = _events(spark, sf_dir).select("event_id", a.alias("a"), b.alias("b"))
    return x.select("event_id", "a", "b",
                    TF.first_present("a", "b", F.lit("UNKNOWN")).alias("picked"),
                    TF.truthy_first("a", "b", F.lit("UNKNOWN")).alias("picked_light"))


# P6 inputs: raw point dates in several layouts, including impossible 8-digit dates.
_P6_RAW_SQL = """CASE event_id % 6
   WHEN 0 THEN strftime(ts, '%Y%m%d')
   WHEN 1 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S')
   WHEN 2 THEN strftime(ts, '%Y-%m-%d')
   WHEN 3 THEN strftime(ts, '%Y') || '13' || strftime(ts, '%d')
   WHEN 4 THEN strftime(ts, '%Y/%m')
   ELSE NULL END"""


@query("p6_norm_date", f"""
SELECT event_id, raw,
       CASE WHEN raw IS NULL THEN NULL
            WHEN regexp_full_match(raw, '[0-9]{{8}}') THEN strftime(try_strptime(raw, '%Y%m%d'), '%Y-%m-%d')
            WHEN length(raw) >= 10 THEN substr(raw, 1, 10)
            ELSE raw END AS norm
FROM (SELECT event_id, {_P6_RAW_SQL} AS raw FROM events)""")
def norm_date_q(spark, sf_dir):
    e, ts = F.col("event_id"), F.col("ts")
    raw = (F.when(e % 6 == 0, F.date_format(ts, "yyyyMMdd"))
           .when(e % 6 == 1, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"))
           .when(e % 6 == 2, F.date_format(ts, "yyyy-MM-dd"))
           .when(e % 6 == 3, F.concat(F.date_format(ts, "yyyy"), F.lit("13"), F.date_format(ts, "dd")))
           .when(e % 6 == 4, F.date_format(ts, "yyyy/MM")))
    x = _events(spark, sf_dir).select("event_id", raw.alias("raw"))
    return x.select("event_id", "raw", TF.norm_date("raw").alias("norm"))


@query("p19_lenient_typing", f"""
SELECT event_id, raw, try_strptime(raw, '%Y-%m-%d')::DATE AS as_date,
       try_strptime(ts_raw, '%Y-%m-%dT%H:%M:%S') AS as_ts
FROM (SELECT event_id,
             CASE WHEN event_id % 3 = 0 THEN 'not a date' ELSE strftime(ts, '%Y-%m-%d') END AS raw,
             CASE WHEN event_id % 4 = 0 THEN 'garbage' ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S') END AS ts_raw
      FROM events)""")
def lenient_q(spark, sf_dir):
    e, ts = F.col("event_id"), F.col("ts")
    x = _events(spark, sf_dir).select(
        "event_id",
        F.when(e % 3 == 0, F.lit("not a date")).otherwise(F.date_format(ts, "yyyy-MM-dd")).alias("raw"),
        F.when(e % 4 == 0, F.lit("garbage")).otherwise(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")).alias("ts_raw"))
    return x.select("event_id", "raw", TF.lenient_date("raw").alias("as_date"),
                    # naive timestamp, like the oracle's TIMESTAMP (the session zone is UTC)
                    TF.lenient_timestamp("ts_raw").cast("timestamp_ntz").alias("as_ts"))
