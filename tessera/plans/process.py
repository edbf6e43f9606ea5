"""Process every planned pair in one set-based pass.

The source handles one (group, day) at a time: fetch, count, write one file, upsert one
manifest row. Here the plan, the extracted rows and the stats are DataFrames: one job writes all
raw files, one append writes all manifest rows, and the attempt records come out as a DataFrame
(a pair without rows is an ``empty_payload`` miss, as in the source).
"""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tessera.functions.dates import compact, lenient_timestamp, parse_ymd
from tessera.operators.ledger import pair_stats
from tessera.session import scratch_dir, write_once
from tessera.sinks.manifest import append_manifest
from tessera.sinks.raw import raw_dir, read_raw, write_raw_days

PAIR = ["group_id", "obs_date"]
EMPTY_MESSAGE = "empty_payload: 0 rows returned"


def process_pairs(plan: DataFrame, obs: DataFrame, *, raw_root: str, manifest_path: str | None,
                  download_ts: str, ingested_at: str, dry_run: bool = False,
                  write_empty: bool = True, records_path: str | None = None) -> DataFrame:
    """Returns attempt records ``(group_id, obs_date ymd, ok, message, counts, volume_path,
    manifest_warning, pass)``.

    ``obs`` must hold strict rows (bronze shape); only planned pairs are processed. With
    ``dry_run`` nothing is written and ``volume_path`` is NULL. ``download_ts`` is the run stamp:
    raw files, records (``records_path``; a scratch folder if not given) and manifest rows are
    written once per stamp, so processing a stamp again changes nothing. A failed raw write turns
    every pair into a ``volume_write_error`` record; a failed manifest append keeps the records and
    fills their ``manifest_warning``.
    """
    spark = obs.sparkSession
    planned = plan.select(*PAIR).distinct()
    if dry_run:
        return _as_records(planned, pair_stats(obs.join(planned, PAIR, "left_semi")), F.lit(None).cast("string"))
    path = raw_dir(F.lit(raw_root), F.col("group_id"), compact("obs_date"), F.lit(download_ts))
    try:
        # One job writes every raw file; the stats are then read back from what was written,
        # which both cuts the lineage and makes the manifest describe the files exactly.
        write_raw_days(obs.join(planned, PAIR, "left_semi"), raw_root, download_ts)
    except Exception as exc:  # noqa: BLE001 — a stage error is a record of every pair it hit
        failed = _as_records(planned, pair_stats(obs.limit(0)), path)
        return failed.withColumn("message", F.lit(f"volume_write_error: {_first_line(exc)}"))
    stats = pair_stats(read_raw(spark, raw_root, run=download_ts))
    records = spark.read.parquet(write_once(
        spark, records_path or scratch_dir(spark, "records"), lambda: _as_records(planned, stats, path)))
    if manifest_path:
        m = records.filter(F.col("ok") | F.lit(write_empty)).select(
            "group_id", parse_ymd(F.col("obs_date")).alias("obs_date"),
            *[F.coalesce(c, F.lit(0)).cast("long").alias(c)
              for c in ("row_count", "instrument_count", "attribute_count")],
            F.when(F.col("ok"), "ok").otherwise("empty").alias("status"),
            "volume_path", lenient_timestamp(F.lit(ingested_at)).alias("ingested_at"))
        try:
            append_manifest(m, manifest_path, download_ts)
        except Exception as exc:  # noqa: BLE001 — the raw files stand; the pairs are asked again
            records = records.withColumn("manifest_warning", F.lit(f"manifest_warning: {_first_line(exc)}"))
    return records


def _first_line(exc: Exception) -> str:
    return f"{type(exc).__name__}: {str(exc).strip().splitlines()[0][:300] if str(exc).strip() else ''}"


def _as_records(planned: DataFrame, stats: DataFrame, path) -> DataFrame:
    ok = F.col("row_count").isNotNull()
    return planned.join(stats, PAIR, "left").select(
        "group_id", compact("obs_date").alias("obs_date"), ok.alias("ok"),
        F.when(ok, F.col("message")).otherwise(F.lit(EMPTY_MESSAGE)).alias("message"),
        "row_count", "instrument_count", "attribute_count", F.when(ok, path).alias("volume_path"),
        F.lit(None).cast("string").alias("manifest_warning"), F.lit(1).alias("pass"))
