"""K1: raw observation files, one folder per (group, day, run).

Layout: ``{raw}/run={YYYYMMDDTHHMMSS}/group={group_id}/day={YYYYMMDD}/part-*.parquet``; every
file carries all seven observation columns, so a recursive scan needs no path parsing. The run
comes first so that reading back one run lists only that run's folders, however much history
the raw area holds. The whole run is written by one job; the ``rebalance`` hint lets AQE split a
hot (group, day) over several tasks and pack small ones together. A run's folder is written once:
writing a complete run again is a no-op, and its commit row (``commits.py``) lets the load take it once.
"""
from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tessera.functions.dates import compact
from tessera.schemas import OBSERVATION_COLUMNS, OBSERVATION_SCHEMA
from tessera.session import write_once
from tessera.sinks.commits import commit_run

RAW_PARTITIONS = ["run", "group", "day"]


def raw_dir(raw_root, group_id, ymd, download_ts):
    """F7 for this layout: folder of one (run, group, day)."""
    root = F.regexp_replace(raw_root if not isinstance(raw_root, str) else F.lit(raw_root), "/+$", "")
    run = download_ts if not isinstance(download_ts, str) else F.lit(download_ts)
    return F.concat(root, F.lit("/run="), run, F.lit("/group="), group_id, F.lit("/day="), ymd)


def write_raw_days(obs: DataFrame, raw_root: str, download_ts: str, *,
                   max_records_per_file: int = 1_000_000) -> None:
    """Write typed observations below ``raw_root`` for run ``download_ts`` (once per run stamp)."""
    def rows():
        return obs.select(*OBSERVATION_COLUMNS, F.col("group_id").alias("group"),
                          compact("obs_date").alias("day")).hint("rebalance", "group", "day")
    write_once(obs.sparkSession, f"{raw_root.rstrip('/')}/run={download_ts}", rows,
               partition_by=RAW_PARTITIONS[1:], maxRecordsPerFile=max_records_per_file,
               partitionOverwriteMode="static")
    commit_run(obs.sparkSession, raw_root, download_ts)


RAW_SCHEMA = T.StructType(OBSERVATION_SCHEMA.fields + [
    T.StructField(c, T.StringType()) for c in RAW_PARTITIONS])


def read_raw(spark: SparkSession, raw_root: str, *, run: str | None = None) -> DataFrame:
    """Raw rows with their folder keys (``run``, ``group``, ``day``). With ``run`` only that
    run's subtree is listed and read."""
    if run is None:
        return spark.read.schema(RAW_SCHEMA).parquet(raw_root)
    root = raw_root.rstrip("/")
    try:
        return spark.read.schema(RAW_SCHEMA).option("basePath", root).parquet(f"{root}/run={run}")
    except AnalysisException as exc:          # a run that wrote no rows has no folder
        if "PATH_NOT_FOUND" not in str(exc):
            raise
        return spark.createDataFrame([], RAW_SCHEMA)


def scan_raw_recursive(spark: SparkSession, raw_root: str) -> DataFrame:
    """Every raw file below ``raw_root`` regardless of layout (no partition discovery), with
    the file each row came from."""
    return (spark.read.schema(OBSERVATION_SCHEMA).option("recursiveFileLookup", "true")
            .parquet(raw_root).select("*", F.col("_metadata.file_path").alias("file_path")))
