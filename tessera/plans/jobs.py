"""The user-level runs: backfill, incremental, tiers and an ad-hoc group fetch (X2-X10 end to end).

A run is a short driver loop over *passes* (at most three), never over data:

1. fetch every pending pair on the executors (``sources.fetch``) and land pages and misses; with an
   attribute listing, pairs whose full response holds no usable point are asked again in chunks;
2. extract rows (full request, else chunks) and process all good pairs in one pass: raw files,
   manifest rows, attempt records (``plans.process``). A pair with a corrupt page, a failed chunk or
   a rejected row (impossible date) is a failed attempt: it is never reported with fewer rows;
3. classify the misses and plan the next pass (``operators.outcomes.retry_plan``); only
   actionable pairs are fetched again, after the longest wait of that pass (``due_retries``: each after its own);
4. load new raw files into bronze exactly once (``streaming.load``) if anything succeeded, and merge small
   loads where that saves enough files (``sinks.bronze.compact_waste``);
5. write the run report and return its summary row (counters from the last attempt of every pair).

Folders (all below ``root``, which must be shared by the cluster): ``landed/run=…/pass=…``,
``attempts/run=…/pass=…``, ``raw``, ``manifest``, ``bronze``, ``_bronze_checkpoint``, ``reports/run=…``.
A run stamp is write-once per stage: running it again reuses what is complete (no vendor call, no
second file) and finishes the rest, so the result is the same however often and wherever it stopped.
"""
from __future__ import annotations

import time

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from tessera.operators.flatten import discover_attributes, flatten_pages, has_usable_point
from tessera.operators.ledger import current
from tessera.operators.outcomes import retry_plan, run_summary
from tessera.plans import ingest
from tessera.plans.extract import attribute_chunks, extract_group_days, light_extract
from tessera.plans.process import process_pairs
from tessera.schemas import MANIFEST_SCHEMA
from tessera.session import write_once
from tessera.sinks.bronze import COMPACT_AFTER, compact_waste
from tessera.sinks.manifest import FOLD_AFTER, fold_manifest, read_live_manifest
from tessera.sources.fetch import (DAILY_REQUEST, fetch_instrument_pages, fetch_pages, land_fetched,
                                   landed_misses, landed_pages)
from tessera.streaming.load import load_new_files

ATTEMPT_LOG_SCHEMA = ("group_id string, obs_date string, ok boolean, message string, row_count long, "
                      "instrument_count long, attribute_count long, volume_path string, "
                      "manifest_warning string, pass int, at_s long")
_LOG_COLUMNS = [c.split()[0] for c in ATTEMPT_LOG_SCHEMA.split(", ")]
YMD_PAIR = ["group_id", "obs_date"]         # obs_date as compact text


def paths(root: str) -> dict:
    r = root.rstrip("/")
    return {"landed": f"{r}/landed", "attempts": f"{r}/attempts", "raw": f"{r}/raw",
            "manifest": f"{r}/manifest", "bronze": f"{r}/bronze", "checkpoint": f"{r}/_bronze_checkpoint",
            "reports": f"{r}/reports"}


def _manifest_or_empty(spark: SparkSession, path: str) -> DataFrame:
    """The manifest; only a folder that does not exist yet means "nothing ingested" (other
    errors surface, answering D13)."""
    try:
        return read_live_manifest(spark, path)
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" not in str(exc):
            raise
        return spark.createDataFrame([], MANIFEST_SCHEMA)


def chunk_items(pairs: DataFrame, attributes: DataFrame, chunk_size: int = 10) -> DataFrame:
    """Work items of the chunk requests of ``pairs(group_id, ymd)``: one per pair and chunk of at most
    ``chunk_size`` discovered attributes of its group."""
    chunks = (attribute_chunks(attributes, chunk_size).groupBy("group_id", "chunk_no")
              .agg(F.transform(F.array_sort(F.collect_list(F.struct("position", "attribute"))),
                               lambda a: a["attribute"]).alias("attributes")))
    return pairs.select("group_id", "ymd").join(chunks, "group_id")


def _fetch_pass(spark, todo, fetch, land, pass_no, ingested_at, request, attributes, chunk_size):
    """Land one pass; returns (pages, misses). Chunks are asked for pairs without a usable point."""
    ask = lambda plan: lambda: fetch_pages(plan, fetch, pass_no=pass_no, ingested_at=ingested_at, request=request)
    full = land_fetched(spark, f"{land}/full", ask(todo))
    pages, misses = landed_pages(spark, full), landed_misses(spark, full)
    if attributes is None:
        return pages, misses
    answered = pages.filter(has_usable_point() | F.col("corrupt")).select(*YMD_PAIR)
    hard = misses.filter(~F.col("message").startswith("empty_payload")).select(*YMD_PAIR)
    pending = (todo.select("group_id", F.col("ymd").alias("obs_date"))
               .join(answered.unionByName(hard).distinct(), YMD_PAIR, "left_anti")
               .withColumnRenamed("obs_date", "ymd"))
    asked = land_fetched(spark, f"{land}/chunks", ask(chunk_items(pending, attributes, chunk_size)))
    return pages.unionByName(landed_pages(spark, asked)), misses.unionByName(landed_misses(spark, asked))


def _failures(pages: DataFrame, misses: DataFrame, rows: DataFrame) -> DataFrame:
    """(group_id, obs_date, message) of the pairs that must not be processed: a call failed (one chunk
    is enough), a page is corrupt, or a row was rejected."""
    hard = misses.filter(~F.col("message").startswith("empty_payload")).select(*YMD_PAIR, "message")
    corrupt = pages.filter("corrupt").select(*YMD_PAIR, F.lit("corrupt_page: a landed page could not be read").alias("message"))
    rejected = rows.filter("rejected").groupBy("group_id", F.date_format("obs_date", "yyyyMMdd").alias("obs_date")).agg(
        F.concat(F.lit("rejected_rows: "), F.count(F.lit(1)).cast("string")).alias("message"))
    return (hard.unionByName(corrupt).unionByName(rejected)
            .groupBy(*YMD_PAIR).agg(F.max("message").alias("message")))


def land_attributes(spark: SparkSession, groups: DataFrame, fetch_attributes, path: str) -> DataFrame:
    """Attribute listing once per group: ``fetch_attributes(group_id) -> pages`` on the executors;
    returns ``group_id, attribute, position`` (P4). A group whose listing failed has no attributes."""
    plan = groups.select("group_id", F.lit("").alias("ymd")).distinct()
    listing = land_fetched(spark, path, lambda: fetch_pages(plan, lambda g, _d, _n: fetch_attributes(g)))
    return discover_attributes(landed_pages(spark, listing))


def _next_step(log: DataFrame, max_pass: int, pass_no: int, now: int, due_retries: bool):
    """(retries of the next step, the second at which it starts or None at the end, its pass number)."""
    timed = log.withColumn("attempted_at", F.timestamp_seconds(F.coalesce("at_s", F.lit(0))))
    retries = retry_plan(timed, max_pass).filter(F.col("action") == "retry")
    if not due_retries:
        retries = retries.filter(F.col("next_pass") == pass_no + 1)
        wait = retries.agg(F.max("wait_s")).first()[0]
        return retries, None if wait is None else now + wait, pass_no + 1
    retries = retries.withColumn("due", F.unix_seconds("not_before"))
    first = retries.agg(F.min(F.struct("due", "next_pass"))).first()[0]
    if first is None:
        return retries, None, pass_no
    return (retries.filter((F.col("due") == first.due) & (F.col("next_pass") == first.next_pass)),
            max(now, first.due), first.next_pass)


def run_pairs(spark: SparkSession, plan: DataFrame, fetch, *, root: str, run_ts: str,
              ingested_at: str, max_pass: int = 3, dry_run: bool = False, load: bool = True,
              request: dict | None = None, sleep=time.sleep, fetch_attributes=None,
              chunk_size: int = 10, due_retries: bool = False) -> DataFrame:
    """Fetch, land, process and retry every pair of ``plan`` (group_id, obs_date, ymd).

    ``request`` holds the vendor parameters forwarded to ``fetch`` (default: the source's daily
    request, ``sources.fetch.DAILY_REQUEST``). With ``fetch_attributes`` the attribute listing is
    fetched once per group, and pairs whose full response is empty are asked again in chunks of
    ``chunk_size`` attributes (the call gets ``attributes=[...]``). Returns the run summary.

    Retries wait pass by pass, for the longest wait of a pass. With ``due_retries`` each failed pair waits
    for its own ``not_before`` instead: the pairs that are due first, of one pass number, make the next step, so a
    short wait is not held up by a long one. Steps are at most one per pass and sum of waits, not per
    pair. Time is counted in waited seconds, so a rerun of the stamp takes the same steps; work only adds to it,
    and no pair is asked before its wait is over."""
    request = DAILY_REQUEST if request is None else request
    p = paths(root)
    # The plan depends on the manifest, which this run changes: a stamp keeps its first plan.
    plan = spark.read.parquet(write_once(spark, f"{p['landed']}/run={run_ts}/plan",
                                         lambda: plan.select("group_id", "obs_date", "ymd")))
    attributes = land_attributes(spark, plan.select("group_id"), fetch_attributes,
                                 f"{p['landed']}/run={run_ts}/attributes") if fetch_attributes else None
    todo, logs, pass_no, now = plan, [], 1, 0
    while True:
        at = f"{now:06d}" if due_retries and now else ""
        step, stamp = f"pass={pass_no}{at and '-at=' + at}", f"{run_ts}p{pass_no}{at and 'd' + at}"
        pages, misses = _fetch_pass(spark, todo, fetch, f"{p['landed']}/run={run_ts}/{step}",
                                    pass_no, ingested_at, request, attributes, chunk_size)
        rows = extract_group_days(pages.filter(~F.col("corrupt")).drop("corrupt"), keep_rejects=True)
        failed = _failures(pages, misses, rows)
        good = todo.join(failed.select("group_id", F.col("obs_date").alias("ymd")), ["group_id", "ymd"], "left_anti")
        done = process_pairs(good, rows.filter(~F.col("rejected")).drop("rejected"), raw_root=p["raw"],
                             manifest_path=p["manifest"], download_ts=stamp,
                             ingested_at=ingested_at, dry_run=dry_run,
                             records_path=f"{p['attempts']}/records/run={run_ts}/{step}")
        nothing = {c.split()[0]: F.lit(None).cast(c.split()[1]) for c in ATTEMPT_LOG_SCHEMA.split(", ")}
        missed = failed.select(*[c if c in failed.columns else
                                 (F.lit(False) if c == "ok" else nothing[c]).alias(c) for c in _LOG_COLUMNS])
        both = (done.withColumn("at_s", F.lit(None).cast("long")).select(*_LOG_COLUMNS).unionByName(missed)
                .withColumn("pass", F.lit(pass_no)).withColumn("at_s", F.lit(now).cast("long")))
        logs.append(write_once(spark, f"{p['attempts']}/run={run_ts}/{step}", lambda b=both: b))
        log = spark.read.schema(ATTEMPT_LOG_SCHEMA).parquet(*logs).withColumn("attempt_id", F.lit(0))
        nxt, due, pass_no = _next_step(log, max_pass, pass_no, now, due_retries)
        if due is None:
            break
        if due > now:
            sleep(due - now)                                 # one pause per step, on the driver
        now = due
        todo = plan.join(nxt.select("group_id", F.col("obs_date").alias("ymd")), ["group_id", "ymd"], "left_semi") \
                   .select("group_id", "obs_date", "ymd")
    if load and not dry_run and log.filter("ok").limit(1).count() > 0:
        load_new_files(spark, p["raw"], p["bronze"], p["checkpoint"])
        compact_waste(spark, p["bronze"], min_loads=COMPACT_AFTER)
    if not dry_run:
        fold_manifest(spark, p["manifest"], min_runs=FOLD_AFTER)
    return run_report(spark, plan, log, run_ts=run_ts, dry_run=dry_run, where=p)


def run_report(spark: SparkSession, plan: DataFrame, log: DataFrame, *, run_ts: str, where: dict,
               dry_run: bool = False) -> DataFrame:
    """Write the run's report below ``reports/run=…`` and return its summary row.

    ``summary`` holds one row: the counters, the planned date range and number of pairs, and the
    folders. ``ranges`` holds one JSON line per planned group (count, first and last day): as rows,
    however many groups there are."""
    out = f"{where['reports']}/run={run_ts}"
    span = plan.agg(F.min("ymd").alias("first_ymd"), F.max("ymd").alias("last_ymd"),
                    F.count(F.lit(1)).alias("total_pairs"))
    summary = run_summary(log, run_ts=run_ts, dry_run=dry_run).select(
        "*", *[span.select(c).scalar().alias(c) for c in ("first_ymd", "last_ymd", "total_pairs")],
        *[F.lit(where[k]).alias(f"{k}_path") for k in ("raw", "manifest", "bronze", "attempts")])
    summary.coalesce(1).write.mode("overwrite").json(f"{out}/summary")
    ingest.range_digest(plan.select("group_id").distinct(), plan).write.mode("overwrite").json(f"{out}/ranges")
    return spark.read.schema(summary.schema).json(f"{out}/summary")


def run_backfill(spark: SparkSession, groups: DataFrame, start, end, fetch, *, root: str, run_ts: str,
                 ingested_at: str, force: bool = False, skip_statuses=("ok",), **kw) -> DataFrame:
    """Backfill: every business day of [start, end] per group whose current manifest status is
    not in ``skip_statuses`` (``('ok',)`` like the source; add ``'empty'`` to stop re-asking)."""
    manifest = _manifest_or_empty(spark, paths(root)["manifest"])
    plan = ingest.backfill_plan(groups, current(manifest), start, end, force=force,
                                skip_statuses=skip_statuses)
    return run_pairs(spark, plan, fetch, root=root, run_ts=run_ts, ingested_at=ingested_at, **kw)


def run_incremental(spark: SparkSession, groups: DataFrame, end, default_start, fetch, *, root: str,
                    run_ts: str, ingested_at: str, **kw) -> DataFrame:
    """Incremental: from each group's watermark + 1 (or ``default_start``) to ``end``."""
    manifest = _manifest_or_empty(spark, paths(root)["manifest"])
    plan = ingest.incremental_plan(groups, current(manifest), end, default_start)
    return run_pairs(spark, plan, fetch, root=root, run_ts=run_ts, ingested_at=ingested_at, **kw)


def fetch_group(spark: SparkSession, group_id: str, days: DataFrame, fetch, fetch_attributes, *, path: str,
                search_ids: DataFrame | None = None, chunk_size: int = 10, request: dict | None = None) -> DataFrame:
    """X10 end to end: attributes of one group, chunk requests for every day of ``days(ymd)``, light
    rows, optionally only those of searched instruments (an empty search gives no rows; the source
    took an empty list for "no restriction"). Failed chunks are in ``landed_misses(spark, path)``."""
    group = spark.range(1).select(F.lit(group_id).alias("group_id"))
    attributes = land_attributes(spark, group, fetch_attributes, f"{path}/attributes")
    items = chunk_items(days.select(F.lit(group_id).alias("group_id"), "ymd").distinct(), attributes, chunk_size)
    land_fetched(spark, f"{path}/chunks", lambda: fetch_pages(
        items, fetch, request=DAILY_REQUEST if request is None else request))
    return light_extract(landed_pages(spark, f"{path}/chunks"), search_ids)


def run_tiers(spark: SparkSession, catalog: DataFrame, fetch, *, end_ymd: str, root: str,
              months: int = 6, unit: str = "Index", tiers_df: DataFrame | None = None,
              save: bool = True, chunk_size: int = 20, run_ts: str = "1") -> DataFrame:
    """X8/X9 end to end: select the instruments of every tier (one plan), fetch their monthly
    window in chunks of ``chunk_size`` ids on the executors, flatten (CPI profile), attach the
    catalog fields, and write one snapshot per tier under ``{root}/tiers/label=<tier>/end=<end>``.
    Returns the rows (read back from the snapshots when ``save``). Pages land once per
    (end, ``run_ts``): the same stamp reuses them, a new stamp fetches anew and replaces the snapshots."""
    import datetime as dt

    from tessera.operators.catalog import select_series
    from tessera.plans import tiers as T

    req = tiers_df if tiers_df is not None else T.tier_requests(spark, catalog, unit)
    end = dt.datetime.strptime(end_ymd, "%Y%m%d").date()
    month = end.year * 12 + end.month - 1 - months
    start = f"{month // 12:04d}{month % 12 + 1:02d}01"
    r = root.rstrip("/")
    landed = land_fetched(spark, f"{r}/tier_pages/end={end_ymd}/run={run_ts}", lambda: fetch_instrument_pages(
        select_series(catalog, req, unit).select("instrument_id"), fetch, start, end_ymd, chunk_size=chunk_size))
    obs = flatten_pages(landed_pages(spark, landed), "cpi")
    rows = T.fetch_series(obs, catalog, req, end_ymd, months=months, unit=unit)
    if not save:
        return rows
    out = f"{r}/tiers"
    (rows.withColumnRenamed("tier", "label").withColumn("end", F.lit(end_ymd))
         .sortWithinPartitions("label", "series", "dataset", "date")
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("label", "end").parquet(out))
    return (spark.read.parquet(out).filter(F.col("end") == end_ymd)
            .withColumnRenamed("label", "tier").drop("end"))
