"""Ledger (manifest) operators: pair stats, watermark, coverage, ingested days, key replace,
latest version (A1-A4, J6, W2, K4).

The manifest is append-only; readers see the current row per key through :func:`current`,
which replaces the source's DELETE-then-append (not atomic, and impossible on plain Parquet).
"""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tessera.functions.dates import compact
from tessera.functions.text import stats_message
from tessera.schemas import MANIFEST_COLUMNS, MANIFEST_KEY


def pair_stats(obs: DataFrame, keys=("group_id", "obs_date"), *, approx: bool = False) -> DataFrame:
    """A1 + F10: rows, distinct instruments and distinct attributes per (group, day).

    The key includes the day, so a hot group is spread over its days. Exact distinct counts
    plan as Expand + partial/final aggregates; ``approx`` switches to HyperLogLog++.
    """
    if approx:
        di, da = (F.approx_count_distinct("instrument"), F.approx_count_distinct("attribute"))
    else:
        di, da = F.countDistinct("instrument"), F.countDistinct("attribute")
    out = obs.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count"),
                                 di.alias("instrument_count"), da.alias("attribute_count"))
    return out.withColumn("message", stats_message("row_count", "instrument_count", "attribute_count"))


SKETCH_BITS = 12            # 2^12 registers: relative standard error of about 1.6 %


def pair_sketches(obs: DataFrame, keys=("group_id", "obs_date"), columns=("instrument", "attribute"), *,
                  bits: int = SKETCH_BITS) -> DataFrame:
    """A1 in mergeable form: per pair ``row_count`` and one distinct-count sketch per column.

    A day's sketches (2^bits registers at most, far less for few values) are written once beside the
    exact counts; :func:`merged_counts` then counts over any span of days from them, without the
    observations. Null values are not counted; a pair with none but nulls has a sketch of nothing.
    """
    return obs.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count"), *[
        F.hll_sketch_agg(c, bits).alias(f"{c}_sketch") for c in columns])


def merged_counts(sketches: DataFrame, keys=("group_id",), columns=("instrument", "attribute")) -> DataFrame:
    """A6 from :func:`pair_sketches`: rows and *estimated* distinct counts of each key over all the pairs given.

    Merging loses nothing: the estimate is as exact as that of one pass over the observations. It is exact to
    rounding for small counts, and beyond has the sketch's error; what must be exact is counted on the
    observations. Row counts are exact."""
    return sketches.groupBy(*keys).agg(F.sum("row_count").alias("row_count"), *[
        F.hll_sketch_estimate(F.hll_union_agg(f"{c}_sketch")).alias(f"{c}_estimate") for c in columns])


def ok_rows(manifest: DataFrame, statuses=("ok",)) -> DataFrame:
    """Manifest rows whose status counts as done."""
    return manifest.filter(F.col("status").isin(*statuses))


def watermark(manifest: DataFrame) -> DataFrame:
    """A2: last ``ok`` day per group, for all groups at once (``last_ok`` DATE, ``last_ymd``)."""
    return (ok_rows(manifest).groupBy("group_id").agg(F.max("obs_date").alias("last_ok"))
            .withColumn("last_ymd", compact("last_ok")))


def coverage(manifest: DataFrame) -> DataFrame:
    """A3: latest day and total rows per group."""
    return manifest.groupBy("group_id").agg(F.max("obs_date").alias("max_obs_date"),
                                            F.sum("row_count").alias("sum_row_count"))


def ingested_days(manifest: DataFrame) -> DataFrame:
    """A4: distinct ``ok`` days per group as compact text."""
    return ok_rows(manifest).select("group_id", compact("obs_date").alias("ymd")).distinct()


def replace_keys(old: DataFrame, new: DataFrame, keys=MANIFEST_KEY) -> DataFrame:
    """Rows of ``old`` whose key is not in ``new``, plus all of ``new``."""
    return old.join(new.select(*keys).distinct(), list(keys), "left_anti").unionByName(new)


def latest_by_key(df: DataFrame, keys, order_cols) -> DataFrame:
    """W2 core: one row per key, the one with the greatest ``order_cols`` tuple.

    Implemented as ``max_by`` in a (sort-based) aggregate rather than a window: partial aggregation
    folds duplicates map-side, so a key holding a third of all rows never sits in one task.
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    best = F.max_by(F.struct(*rest), F.struct(*order_cols)).alias("_best")
    return df.groupBy(*keys).agg(best).select(*keys, *[F.col("_best")[c].alias(c) for c in rest])


RUN = "run"      # run stamp of a manifest row (with the pass at its end)


def current(manifest: DataFrame, keep_run: bool = False) -> DataFrame:
    """Current manifest: newest ``ingested_at`` per (group, day), ties by run stamp, then path. The
    current rows of current rows and newer ones are the current rows of all (see ``sinks.manifest``);
    ``keep_run`` keeps the stamp for that."""
    run = F.col(RUN) if RUN in manifest.columns else F.lit(None).cast("string")
    rows = manifest.select(*MANIFEST_COLUMNS, run.alias("_run"))
    best = latest_by_key(rows, MANIFEST_KEY, [F.col("ingested_at"), F.col("_run"), F.col("volume_path")])
    return best.withColumnRenamed("_run", RUN) if keep_run else best.drop("_run")


OBSERVATION_KEY = ["group_id", "instrument", "attribute", "date"]


def latest_observations(bronze: DataFrame, *, file_col: str | None = None) -> DataFrame:
    """One row per (group, instrument, attribute, date): newest ingest, then file name."""
    order = [F.col("ingested_at")]
    if file_col:
        order.append(F.col(file_col))
    order.append(F.col("value"))
    return latest_by_key(bronze, OBSERVATION_KEY, order)
