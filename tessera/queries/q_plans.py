"""Planning queries: X2, X3, J4, J5, A2, A3, A4, A9, A10, R2."""
from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import ledger
from tessera.queries import analogues as A
from tessera.plans import ingest
from tessera.queries.common import DEFAULT_WINDOW_DAYS, SPAN_SQL, event_span
from tessera.registry import query

_GROUPS_SQL = "groups AS (SELECT DISTINCT group_id FROM v2)"


def backfill_missing(spark, sf_dir):
    m = A.manifest(spark, sf_dir)
    start, end = event_span(spark, sf_dir)
    groups = m.select("group_id").distinct()
    return ingest.backfill_plan(groups, m, start, end).select("group_id", "obs_date", "ymd")


X2_SQL = A.with_views("v2") + f""", {SPAN_SQL}, {_GROUPS_SQL},
days AS (SELECT CAST(x AS DATE) AS obs_date FROM span,
         generate_series(CAST(span.s AS TIMESTAMP), CAST(span.e AS TIMESTAMP), INTERVAL 1 DAY) g(x)
         WHERE isodow(x) < 6)
SELECT g.group_id, d.obs_date, strftime(d.obs_date, '%Y%m%d') AS ymd
FROM groups g CROSS JOIN days d
WHERE NOT EXISTS (SELECT 1 FROM v2 WHERE v2.group_id = g.group_id AND v2.obs_date = d.obs_date
                  AND v2.status = 'ok')"""

query("x2_backfill_plan", X2_SQL)(backfill_missing)
query("j5_plan_anti_manifest", X2_SQL)(backfill_missing)


@query("j4_work_items", A.with_views("v2") + f""", {SPAN_SQL}, {_GROUPS_SQL},
days AS (SELECT CAST(x AS DATE) AS obs_date FROM span,
         generate_series(CAST(span.s AS TIMESTAMP), CAST(span.e AS TIMESTAMP), INTERVAL 1 DAY) g(x)
         WHERE isodow(x) < 6)
SELECT g.group_id, d.obs_date, strftime(d.obs_date, '%Y%m%d') AS ymd FROM groups g CROSS JOIN days d""")
def work_items_q(spark, sf_dir):
    m = A.manifest(spark, sf_dir)
    start, end = event_span(spark, sf_dir)
    return ingest.work_items(m.select("group_id").distinct(), start, end)


@query("a10_total_pairs", A.with_views("v2") + f""", {SPAN_SQL}, {_GROUPS_SQL},
days AS (SELECT CAST(x AS DATE) AS obs_date FROM span,
         generate_series(CAST(span.s AS TIMESTAMP), CAST(span.e AS TIMESTAMP), INTERVAL 1 DAY) g(x)
         WHERE isodow(x) < 6)
SELECT COUNT(*) AS total_pairs FROM groups CROSS JOIN days""")
def total_pairs_q(spark, sf_dir):
    return ingest.total_pairs(work_items_q(spark, sf_dir))


def _incremental(spark, sf_dir):
    """Groups are every user of the events table plus the manifest; the run's ``end`` is the
    last event day and the default start is ``end`` - 730 days."""
    m = A.manifest(spark, sf_dir)
    start, end = event_span(spark, sf_dir)
    groups = m.select("group_id").distinct()
    plan = ingest.incremental_plan(groups, m, end, F.date_sub(end, DEFAULT_WINDOW_DAYS))
    return groups, m, plan


_X3_SQL_BODY = f""", {SPAN_SQL}, {_GROUPS_SQL},
wm AS (SELECT group_id, max(obs_date) AS last_ok FROM v2 WHERE status = 'ok' GROUP BY group_id),
starts AS (SELECT g.group_id,
                  coalesce(CAST(wm.last_ok + INTERVAL 1 DAY AS DATE),
                           CAST((SELECT e FROM span) - INTERVAL {DEFAULT_WINDOW_DAYS} DAY AS DATE)) AS start
           FROM groups g LEFT JOIN wm USING (group_id)),
plan AS (SELECT s.group_id, CAST(x AS DATE) AS obs_date
         FROM starts s, generate_series(CAST(s.start AS TIMESTAMP), CAST((SELECT e FROM span) AS TIMESTAMP),
                                        INTERVAL 1 DAY) g(x)
         WHERE isodow(x) < 6)"""


@query("x3_incremental_plan", A.with_views("v2") + _X3_SQL_BODY + """
SELECT group_id, obs_date, strftime(obs_date, '%Y%m%d') AS ymd FROM plan""")
def incremental_q(spark, sf_dir):
    return _incremental(spark, sf_dir)[2]


@query("a9_range_digest", A.with_views("v2") + _X3_SQL_BODY + """
SELECT g.group_id, CAST(coalesce(p.n_days, 0) AS BIGINT) AS n_days, p.first_ymd, p.last_ymd
FROM groups g LEFT JOIN (SELECT group_id, COUNT(*) AS n_days,
                                min(strftime(obs_date, '%Y%m%d')) AS first_ymd,
                                max(strftime(obs_date, '%Y%m%d')) AS last_ymd
                         FROM plan GROUP BY group_id) p USING (group_id)""")
def range_digest_q(spark, sf_dir):
    groups, _, plan = _incremental(spark, sf_dir)
    return ingest.range_digest(groups, plan)


@query("a2_watermark", A.with_views("v2") + """
SELECT group_id, max(obs_date) AS last_ok, strftime(max(obs_date), '%Y%m%d') AS last_ymd
FROM v2 WHERE status = 'ok' GROUP BY group_id""")
def watermark_q(spark, sf_dir):
    return ledger.watermark(A.manifest(spark, sf_dir))


@query("a3_coverage", A.with_views("v2") + """
SELECT group_id, max(obs_date) AS max_obs_date, CAST(sum(row_count) AS BIGINT) AS sum_row_count
FROM v2 GROUP BY group_id""")
def coverage_q(spark, sf_dir):
    return ledger.coverage(A.manifest(spark, sf_dir))


@query("a4_ingested_days", A.with_views("v2") + """
SELECT DISTINCT group_id, strftime(obs_date, '%Y%m%d') AS ymd FROM v2 WHERE status = 'ok'""")
def ingested_days_q(spark, sf_dir):
    return ledger.ingested_days(A.manifest(spark, sf_dir))


@query("p14_ok_pairs", A.with_views("v2") + """
SELECT group_id, obs_date, row_count FROM v2 WHERE status = 'ok'""")
def ok_pairs_q(spark, sf_dir):
    return ledger.ok_rows(A.manifest(spark, sf_dir)).select("group_id", "obs_date", "row_count")
