"""File and streaming queries: K1, K2/M1, K3, S6, S7, P17, X4, X6, X11."""
from __future__ import annotations

from pyspark.sql import functions as F

from tessera.queries import analogues as A
from tessera.plans import ingest
from tessera.plans.process import process_pairs
from tessera.queries.common import event_span
from tessera.registry import query
from tessera.session import scratch_dir
from tessera.sinks import bronze as B
from tessera.sinks.raw import read_raw, scan_raw_recursive, write_raw_days
from tessera.streaming.load import load_new_files

OBS_OUT = ["group_id", "instrument", "attribute", "date", "value", "obs_date"]


def _raw_v1(spark, sf_dir):
    """V1 written as raw day files for run RUN_TS (K1); returns the raw root."""
    root = scratch_dir(spark, "raw")
    write_raw_days(A.observations(spark, sf_dir), root, A.RUN_TS)
    return root


def _bronze_v1(spark, sf_dir):
    """V1 written in bronze layout by the batch writer (K3); returns the bronze path."""
    path = scratch_dir(spark, "bronze")
    B.write_bronze(A.observations(spark, sf_dir), path)
    return path


V1_OUT_SQL = A.with_views("v1") + "SELECT group_id, instrument, attribute, date, value, obs_date FROM v1"
RUN2 = "20240202T000000"


@query("k1_raw_day_write", V1_OUT_SQL)
def raw_write_q(spark, sf_dir):
    return read_raw(spark, _raw_v1(spark, sf_dir), run=A.RUN_TS).select(*OBS_OUT)


@query("s6_recursive_raw_scan", A.with_views("v1") + """
SELECT group_id, strftime(obs_date, '%Y%m%d') AS day, COUNT(*) AS n_rows FROM v1 GROUP BY 1, 2""")
def recursive_scan_q(spark, sf_dir):
    rows = scan_raw_recursive(spark, _raw_v1(spark, sf_dir))
    day = F.regexp_extract("file_path", r"/day=([0-9]{8})/", 1)
    return rows.groupBy("group_id", day.alias("day")).agg(F.count(F.lit(1)).alias("n_rows"))


def _two_pass_bronze(spark, sf_dir):
    """Raw files arrive in two runs (days 1-15, then the rest); bronze is loaded after each run
    and once more with nothing new. Returns (raw_root, bronze_path)."""
    root, bronze, ck = (scratch_dir(spark, "raw"), scratch_dir(spark, "bronze"),
                        scratch_dir(spark, "bronze-ckpt"))
    v1 = A.observations(spark, sf_dir)
    write_raw_days(v1.filter(F.dayofmonth("obs_date") <= 15), root, A.RUN_TS)
    load_new_files(spark, root, bronze, ck)
    write_raw_days(v1.filter(F.dayofmonth("obs_date") > 15), root, RUN2)
    load_new_files(spark, root, bronze, ck)
    load_new_files(spark, root, bronze, ck)   # no new files: loads nothing
    return root, bronze


@query("k2_exactly_once_load", V1_OUT_SQL)
def exactly_once_q(spark, sf_dir):
    _, bronze = _two_pass_bronze(spark, sf_dir)
    return B.read_bronze(spark, bronze).select(*OBS_OUT)


@query("x11_rebuild_bronze", V1_OUT_SQL)
def rebuild_q(spark, sf_dir):
    root, _ = _two_pass_bronze(spark, sf_dir)
    rebuilt, ck = scratch_dir(spark, "bronze-rebuild"), scratch_dir(spark, "bronze-rebuild-ckpt")
    load_new_files(spark, root, rebuilt, ck)
    return B.read_bronze(spark, rebuilt).select(*OBS_OUT)


@query("k3_bronze_partition_read", A.with_views("v1") + """
SELECT group_id, instrument, attribute, date, value, obs_date FROM v1
WHERE obs_date BETWEEN DATE '2024-01-08' AND DATE '2024-01-19'""")
def partition_read_q(spark, sf_dir):
    return B.read_bronze(spark, _bronze_v1(spark, sf_dir), start="2024-01-08", end="2024-01-19").select(*OBS_OUT)


def loaded_in_runs(spark, sf_dir):
    """Bronze of five loads: the days up to the 20th, then four small ones by day of month."""
    root, bronze, ck = (scratch_dir(spark, "raw"), scratch_dir(spark, "bronze"), scratch_dir(spark, "bronze-ckpt"))
    v1, day = A.observations(spark, sf_dir), F.dayofmonth("obs_date")
    for k in range(5):
        part = v1.where(day <= 20) if k == 0 else v1.where((day > 20) & (day % 4 == k - 1))
        write_raw_days(part, root, f"2024020{k + 1}T000000")
        load_new_files(spark, root, bronze, ck)
    return bronze


@query("k3_partial_compaction", V1_OUT_SQL)
def partial_compaction_q(spark, sf_dir):
    """All rows once after only the small loads were merged (fan and waste bound chosen for the fixture)."""
    bronze = loaded_in_runs(spark, sf_dir)
    B.compact_waste(spark, bronze, fan=1, waste=0.0)
    return B.read_bronze(spark, bronze).select(*OBS_OUT)


@query("s7_table_read", A.with_views("v1") + """
SELECT group_id, COUNT(*) AS n_rows, max(obs_date) AS max_obs_date FROM v1 GROUP BY group_id""")
def table_read_q(spark, sf_dir):
    return B.read_bronze(spark, _bronze_v1(spark, sf_dir)).groupBy("group_id").agg(
        F.count(F.lit(1)).alias("n_rows"), F.max("obs_date").alias("max_obs_date"))


@query("p17_cast_projection", A.with_views("v1") + """
SELECT group_id, instrument, attribute, CASE WHEN event_id % 13 = 0 THEN NULL ELSE date END AS date,
       value, obs_date FROM v1""")
def cast_projection_q(spark, sf_dir):
    """Raw files written by an older writer: dates as text (some unparsable), an extra column."""
    path = scratch_dir(spark, "raw-drift")
    v1 = A.observations(spark, sf_dir, helpers=True)
    drift = v1.select(
        "group_id", "instrument", "attribute",
        F.when(F.col("event_id") % 13 == 0, F.lit("n/a")).otherwise(F.date_format("date", "yyyy-MM-dd")).alias("date"),
        "value", F.date_format("obs_date", "yyyy-MM-dd").alias("obs_date"),
        F.date_format("ingested_at", "yyyy-MM-dd'T'HH:mm:ss").alias("ingested_at"),
        F.lit("legacy").alias("note"))
    drift.write.mode("overwrite").parquet(path)
    raw = spark.read.option("mergeSchema", "true").option("recursiveFileLookup", "true").parquet(path)
    return B.cast_projection(raw).select(*OBS_OUT)


def _groups_plan(spark, sf_dir):
    v1 = A.observations(spark, sf_dir)
    start, end = event_span(spark, sf_dir)
    return v1, ingest.work_items(v1.select("group_id").distinct(), start, end)


_X4_SQL = A.with_views("v1") + """,
span AS (SELECT min(CAST(ts AS DATE)) AS s, max(CAST(ts AS DATE)) AS e FROM events),
days AS (SELECT CAST(x AS DATE) AS obs_date FROM span,
         generate_series(CAST(span.s AS TIMESTAMP), CAST(span.e AS TIMESTAMP), INTERVAL 1 DAY) g(x) WHERE isodow(x) < 6),
plan AS (SELECT g.group_id, d.obs_date FROM (SELECT DISTINCT group_id FROM v1) g CROSS JOIN days d),
stats AS (SELECT group_id, obs_date, COUNT(*) AS row_count, COUNT(DISTINCT instrument) AS instrument_count,
                 COUNT(DISTINCT attribute) AS attribute_count FROM v1 GROUP BY 1, 2)"""


X4_SQL = _X4_SQL + """
SELECT p.group_id, strftime(p.obs_date, '%Y%m%d') AS obs_date, s.row_count IS NOT NULL AS ok,
       CASE WHEN s.row_count IS NULL THEN 'empty_payload: 0 rows returned'
            ELSE 'rows=' || s.row_count || ' instruments=' || s.instrument_count || ' attributes=' || s.attribute_count END AS message,
       s.row_count, s.instrument_count, s.attribute_count, 1 AS pass
FROM plan p LEFT JOIN stats s USING (group_id, obs_date)"""


def _processed(spark, sf_dir):
    """One processing run over all planned pairs (X4); returns (records, raw root)."""
    v1, plan = _groups_plan(spark, sf_dir)
    root, manifest = scratch_dir(spark, "raw"), scratch_dir(spark, "manifest")
    rec = process_pairs(plan, v1, raw_root=root, manifest_path=manifest, download_ts=A.RUN_TS,
                        ingested_at="2024-02-01T00:00:00")
    return rec, root


@query("x4_process_pairs", X4_SQL)
def process_q(spark, sf_dir):
    return _processed(spark, sf_dir)[0].drop("volume_path", "manifest_warning")


@query("x6_bronze_load", _X4_SQL + """
SELECT group_id, obs_date, row_count FROM stats WHERE isodow(obs_date) < 6""")
def bronze_load_q(spark, sf_dir):
    rec, root = _processed(spark, sf_dir)
    bronze, ck = scratch_dir(spark, "bronze"), scratch_dir(spark, "bronze-ckpt")
    # Load only if the run produced something (an empty source would be a no-op anyway)
    if rec.filter("ok").limit(1).count() > 0:
        load_new_files(spark, root, bronze, ck)
    return B.read_bronze(spark, bronze).groupBy("group_id", "obs_date").agg(
        F.count(F.lit(1)).alias("row_count"))


@query("s7_sql_coverage", A.with_views("v2") + """
SELECT group_id, max(obs_date) AS max_obs_date, CAST(sum(row_count) AS BIGINT) AS sum_row_count
FROM v2 GROUP BY group_id""")
def sql_coverage_q(spark, sf_dir):
    """The coverage check as SQL over the registered manifest view (S7 + A3)."""
    import uuid

    from tessera.sinks.manifest import append_manifest
    from tessera.sources.tables import register_views
    path = scratch_dir(spark, "manifest")
    append_manifest(A.manifest(spark, sf_dir), path)
    prefix = f"t{uuid.uuid4().hex[:8]}_"
    register_views(spark, manifest=path, prefix=prefix)
    return spark.sql(f"SELECT group_id, max(obs_date) AS max_obs_date, sum(row_count) AS sum_row_count "
                     f"FROM {prefix}manifest GROUP BY group_id")
