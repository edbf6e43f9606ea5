"""CPI tier selection and series fetch.

All tiers run as **one** plan: a tier table ``(tier, series, req_pos, dataset_regex)`` is joined
to the catalog (J1, equi form), the selected ids restrict the price observations (J7) and carry
their lookups (J3), and a date window ``[months_back(end, n), end]`` is applied before the join
so it is pushed to the scan. Nothing is collected to the driver.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tessera.functions.dates import months_back, ymd_to_iso
from tessera.operators.catalog import all_items_series, missing_series, select_series
from tessera.plans.curated import (ALL_ITEMS_DATASET, ALL_ITEMS_PREFIX, ALL_ITEMS_REGEX,
                                   tier_rows)
from tessera.util import lit_or_col


def curated_requests(spark: SparkSession) -> DataFrame:
    """The three curated tiers as a DataFrame (bounded by the fixed lists: 113 rows)."""
    return spark.createDataFrame(tier_rows(), "tier string, series string, req_pos int, dataset_regex string")


def all_items_requests(cat: DataFrame, unit: str = "Index") -> DataFrame:
    """Tier 4 requests: every all-items series of the catalog (no request order: ``req_pos``
    is NULL and reports fall back to series order)."""
    s = all_items_series(cat, unit, ALL_ITEMS_DATASET, ALL_ITEMS_PREFIX)
    return s.select(F.lit("all_items").alias("tier"), "series", F.lit(None).cast("int").alias("req_pos"),
                    F.lit(ALL_ITEMS_REGEX).alias("dataset_regex"))


def tier_requests(spark: SparkSession, cat: DataFrame, unit: str = "Index") -> DataFrame:
    return curated_requests(spark).unionByName(all_items_requests(cat, unit))


def window_bounds(end_ymd, months: int = 6):
    """ISO bounds of the fetch window: first day ``months`` back, and the end day."""
    end = lit_or_col(end_ymd)
    return ymd_to_iso(months_back(end, F.lit(months))), ymd_to_iso(end)


SORT_KEYS = ["tier", "series", "dataset", "date", "instrument_id", "value"]


def sort_rows(rows: DataFrame) -> DataFrame:
    """Order by (tier,) series, dataset, date — a global sort, for consumers that need it."""
    return rows.orderBy(*[c for c in SORT_KEYS if c in rows.columns])


def fetch_series(obs: DataFrame, cat: DataFrame, requests: DataFrame, end_ymd, *, months: int = 6,
                 unit: str = "Index", sort: bool = False, few: bool = False) -> DataFrame:
    """X8 (one tier or many): price rows of the selected instruments inside the window.

    ``obs`` is the CPI flatten output (date text, instrument_id, value); ``end_ymd`` is the
    window end (``YYYYMMDD`` text or Column). The result has the CPI schema plus ``tier``.
    ``sort=True`` applies T1 here; otherwise sort when consuming (:func:`sort_rows`) or within
    partitions when writing (:func:`save_snapshot`), which avoids a range-partitioning pass.

    The selection is the side that is hashed, one shuffle partition at a time, and the price rows
    stream past it unsorted. Without the hint Spark broadcasts the price rows of a few hundred MB
    of pages: it takes them for small, as few columns of the page schema are left. ``few`` as in
    :func:`select_series`.
    """
    sel = select_series(cat, requests, unit, few=few).select("tier", "instrument_id", "series", "dataset", "name")
    lo, hi = window_bounds(end_ymd, months)
    win = obs.filter((F.col("date") >= lo) & (F.col("date") <= hi))
    rows = win.join(sel.hint("shuffle_hash"), "instrument_id")
    out = rows.select("tier", "date", "instrument_id", "series", "dataset", F.lit(unit).alias("unit"),
                      F.col("value").cast("double").alias("value"), F.col("name").alias("instrument_name"))
    return sort_rows(out) if sort else out


def preview(rows: DataFrame, n: int = 10) -> DataFrame:
    """The first ``n`` rows in (series, dataset, date) order (a preview; the limit is the
    feature)."""
    return rows.orderBy("series", "dataset", "date", "instrument_id", "value").limit(n)


def first_missing(requests: DataFrame, selected: DataFrame, n: int = 5) -> DataFrame:
    """Per tier, the first ``n`` missing series in request order, plus how many are missing.

    The window runs over missing *requests* only (bounded by the request lists)."""
    miss = missing_series(requests, selected)
    w = Window.partitionBy("tier").orderBy(F.col("req_pos").asc_nulls_last(), "series")
    counted = miss.withColumn("n_missing", F.count(F.lit(1)).over(Window.partitionBy("tier")))
    return (counted.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)
            .select("tier", "series", "req_pos", "n_missing"))


def save_snapshot(rows: DataFrame, root: str, label: str, end_ymd: str) -> str:
    """K5: write a tier result under ``{root}/label={label}/end={end}``."""
    path = f"{root.rstrip('/')}/label={label}/end={end_ymd}"
    rows.sortWithinPartitions(*[c for c in SORT_KEYS if c in rows.columns]).write.mode("overwrite").parquet(path)
    return path
