"""Work planning: backfill and incremental plans, range digest, totals.

A plan is a lazily evaluated DataFrame of (group, business day) work items. Days are generated
per group row (``explode`` of a guarded date sequence), so there is no driver loop and no
cartesian product; the skip test is one anti join against the manifest instead of one query per
pair.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tessera.functions.dates import compact, date_value, explode_business_days
from tessera.operators.ledger import ok_rows, watermark


def work_items(groups: DataFrame, start, end) -> DataFrame:
    """``groups`` x business days of ``[start, end]`` -> (group_id, obs_date, ymd)."""
    return (explode_business_days(groups.select("group_id"), start, end)
            .withColumn("ymd", compact("obs_date")))


def backfill_plan(groups: DataFrame, manifest: DataFrame, start, end, *, force: bool = False,
                  skip_statuses=("ok",)) -> DataFrame:
    """X2 = J4 then J5: work items not yet ingested (unless ``force``).

    ``skip_statuses`` defaults to ``('ok',)`` like the source; add ``'empty'`` to stop asking
    again for days that were legitimately empty.
    """
    plan = work_items(groups, start, end)
    if force:
        return plan
    done = ok_rows(manifest, skip_statuses).select("group_id", "obs_date")
    return plan.join(done, ["group_id", "obs_date"], "left_anti")


def group_starts(groups: DataFrame, manifest: DataFrame, default_start) -> DataFrame:
    """X3 step 1: per group the day after its watermark, or ``default_start`` without one."""
    wm = watermark(manifest).select("group_id", "last_ok")
    return (groups.join(wm, "group_id", "left")
            .withColumn("start", F.coalesce(F.date_add("last_ok", 1), date_value(default_start))))


def incremental_plan(groups: DataFrame, manifest: DataFrame, end, default_start) -> DataFrame:
    """From each group's watermark + 1 (or ``default_start``) to ``end`` (DATE Columns or
    date text); a group whose start
    lies after ``end`` contributes nothing (P22). Days below the watermark are not revisited
    (that is what the backfill plan is for)."""
    starts = group_starts(groups, manifest, default_start)
    return (explode_business_days(starts.select("group_id", "start"), F.col("start"), end)
            .select("group_id", "obs_date", compact("obs_date").alias("ymd")))


def range_digest(groups: DataFrame, plan: DataFrame) -> DataFrame:
    """Per group the count, first and last planned day (0 / NULL / NULL when up to date)."""
    d = plan.groupBy("group_id").agg(F.count(F.lit(1)).alias("n_days"),
                                     F.min("ymd").alias("first_ymd"), F.max("ymd").alias("last_ymd"))
    return (groups.join(d, "group_id", "left")
            .select("group_id", F.coalesce("n_days", F.lit(0)).cast("long").alias("n_days"),
                    "first_ymd", "last_ymd"))


def total_pairs(plan: DataFrame) -> DataFrame:
    """A10: number of work items, as a one-row DataFrame."""
    return plan.agg(F.count(F.lit(1)).alias("total_pairs"))
