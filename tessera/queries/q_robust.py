"""What must not get lost: corrupt pages, rejects, schema drift, reruns, compaction, the run report."""
from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators.flatten import flatten_pages
from tessera.queries import analogues as A
from tessera.plans import jobs
from tessera.plans.process import process_pairs
from tessera.queries.q_files import _X4_SQL, OBS_OUT, RUN2, V1_OUT_SQL, _groups_plan
from tessera.queries.q_plans import _X3_SQL_BODY, _incremental
from tessera.registry import query
from tessera.session import scratch_dir
from tessera.sinks import bronze as B
from tessera.sinks.raw import write_raw_days
from tessera.sources.pages import corrupt_pages, read_pages, write_pages
from tessera.streaming.load import load_new_files


@query("s1_corrupt_pages", A.with_views("v1") + """,
pages AS (SELECT DISTINCT group_id, date, user_id // 16 AS page_no FROM v1)
SELECT COUNT(*) FILTER (WHERE page_no % 3 = 1) AS corrupt, COUNT(*) FILTER (WHERE page_no % 3 <> 1) AS good FROM pages""")
def corrupt_pages_q(spark, sf_dir):
    """Every third page is cut short when it lands: none of them is lost without a trace."""
    pages = A.observation_pages(A.observations(spark, sf_dir, helpers=True))
    number = F.regexp_extract("value", '"page_no":([0-9]+)', 1).cast("int")
    cut = pages.select(F.when(number % 3 == 1, F.expr("substring(value, 1, length(value) - 9)"))
                       .otherwise(F.col("value")).alias("value"))
    path = write_pages(cut, scratch_dir(spark, "pages-cut"))
    bad = corrupt_pages(spark, path).agg(F.count(F.lit(1)).alias("corrupt"))
    good = read_pages(spark, path, on_corrupt="drop").select("group_id", "instruments").agg(
        F.count("instruments").alias("good"))
    return bad.select("corrupt", good.scalar().alias("good"))


@query("p1_rejects", A.with_views("v1") + """
SELECT group_id, instrument, attribute, CASE WHEN event_id % 5 = 2 AND day(date) = 10 THEN NULL ELSE date END AS date,
       value, obs_date, event_id % 5 = 2 AND day(date) = 10 AS rejected FROM v1""")
def strict_rejects_q(spark, sf_dir):
    """Compact dates of one day are made impossible (day 99): those rows are flagged, not dropped."""
    pages = A.observation_pages(A.observations(spark, sf_dir, helpers=True))
    broken = pages.select(F.regexp_replace("value", r'\["([0-9]{6})10"', '["$199"').alias("value"))
    path = write_pages(broken, scratch_dir(spark, "pages-rejects"))
    return flatten_pages(read_pages(spark, path), keep_rejects=True).drop("ingested_at")


@query("p3_rejects", A.with_views("v6") + """
SELECT date, instrument_id, value, value IS NULL AS rejected FROM v6""")
def cpi_rejects_q(spark, sf_dir):
    """Missing prices arrive as a text that is no number: flagged rejects, never rows without a value."""
    pages = A.price_pages(A.price_points(spark, sf_dir))
    broken = pages.select(F.regexp_replace("value", '"value":null', '"value":"n/a"').alias("value"))
    path = write_pages(broken, scratch_dir(spark, "pages-cpi-rejects"))
    return flatten_pages(read_pages(spark, path), "cpi", keep_rejects=True)


@query("k2_schema_drift", V1_OUT_SQL)
def schema_drift_q(spark, sf_dir):
    """Three writers, one load: typed files, text dates with an extra column, a missing column."""
    raw, bronze, ck = (scratch_dir(spark, n) for n in ("raw-drift", "bronze-drift", "bronze-drift-ckpt"))
    v1 = A.observations(spark, sf_dir)
    day = F.dayofmonth("obs_date")
    write_raw_days(v1.filter(day <= 10), raw, A.RUN_TS)
    old = v1.filter((day > 10) & (day <= 20))
    (old.withColumn("date", F.date_format("date", "yyyy-MM-dd")).withColumn("note", F.lit("legacy"))
        .withColumn("obs_date", F.date_format("obs_date", "yyyy-MM-dd")).write.parquet(f"{raw}/run={RUN2}"))
    v1.filter(day > 20).drop("ingested_at").write.parquet(f"{raw}/run=20240203T000000")
    load_new_files(spark, raw, bronze, ck)
    return B.read_bronze(spark, bronze).select(*OBS_OUT)


@query("k3_compacted_read", V1_OUT_SQL)
def compacted_read_q(spark, sf_dir):
    """Two loads, a compaction in place, a load with nothing new: readers see every row once."""
    raw, bronze, ck = (scratch_dir(spark, n) for n in ("raw", "bronze", "bronze-ckpt"))
    v1 = A.observations(spark, sf_dir)
    write_raw_days(v1.filter(F.dayofmonth("obs_date") <= 15), raw, A.RUN_TS)
    load_new_files(spark, raw, bronze, ck)
    write_raw_days(v1.filter(F.dayofmonth("obs_date") > 15), raw, RUN2)
    load_new_files(spark, raw, bronze, ck)
    B.compact_bronze(spark, bronze)
    load_new_files(spark, raw, bronze, ck)
    return B.read_bronze(spark, bronze).select(*OBS_OUT)


@query("x4_rerun", _X4_SQL + """
SELECT group_id, obs_date, row_count FROM stats WHERE isodow(obs_date) < 6""")
def rerun_q(spark, sf_dir):
    """The same run stamp processed and loaded twice: bronze holds every row once."""
    v1, plan = _groups_plan(spark, sf_dir)
    root, manifest, bronze, ck = (scratch_dir(spark, n) for n in ("raw", "manifest", "bronze", "bronze-ckpt"))
    for _ in range(2):
        process_pairs(plan, v1, raw_root=root, manifest_path=manifest, download_ts=A.RUN_TS,
                      ingested_at="2024-02-01T00:00:00")
        load_new_files(spark, root, bronze, ck)
    return B.read_bronze(spark, bronze).groupBy("group_id", "obs_date").agg(F.count(F.lit(1)).alias("row_count"))


@query("x7_report_ranges", A.with_views("v2") + _X3_SQL_BODY + """
SELECT g.group_id, CAST(p.n_days AS BIGINT) AS n_days, p.first_ymd, p.last_ymd
FROM groups g JOIN (SELECT group_id, COUNT(*) AS n_days, min(strftime(obs_date, '%Y%m%d')) AS first_ymd,
                           max(strftime(obs_date, '%Y%m%d')) AS last_ymd FROM plan GROUP BY group_id) p USING (group_id)""")
def report_ranges_q(spark, sf_dir):
    """The written report of an incremental run: one line per planned group."""
    _, _, plan = _incremental(spark, sf_dir)
    where = jobs.paths(scratch_dir(spark, "report"))
    log = A.attempts(spark, sf_dir)
    jobs.run_report(spark, plan, log, run_ts=A.RUN_TS, where=where)
    return spark.read.schema("group_id string, n_days long, first_ymd string, last_ymd string").json(
        f"{where['reports']}/run={A.RUN_TS}/ranges")
