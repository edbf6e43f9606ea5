"""Vendor-delegated request semantics, re-aimed as optional operators.

The source only passes ``calendar``, ``frequency``, ``conversion`` and ``nan_treatment`` to the
vendor. Their meaning here is inferred from the names alone (a labelled assumption):
``FREQ_MONTH`` + ``CONV_LASTBUS_ABS`` = the value on the last business day of each month,
``CAL_*`` = weekdays minus a holiday calendar, ``NA_NOTHING`` = keep NULL values.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tessera.functions.dates import calendar_days, date_value, explode_business_days


def monthly_last_business(obs: DataFrame, keys=("group_id", "instrument", "attribute"),
                          date_col: str = "date", value_col: str = "value",
                          tiebreak: str = "ingested_at") -> DataFrame:
    """Per key and month, the value observed on the last weekday of that month that has
    data (``max_by`` in a sort-based aggregate; no window, no sort of a whole key)."""
    wk = obs.filter(F.weekday(F.col(date_col)) < 5)
    order = F.struct(F.col(date_col), F.col(tiebreak)) if tiebreak in obs.columns else F.col(date_col)
    return (wk.groupBy(*keys, F.trunc(F.col(date_col), "MM").alias("month"))
            .agg(F.max_by(F.col(value_col), order).alias(value_col),
                 F.max(F.col(date_col)).alias("as_of")))


def business_days_except(groups: DataFrame, start, end, holidays: DataFrame) -> DataFrame:
    """R2: weekdays of ``[start, end]`` per group, minus a holiday calendar (``holiday`` DATE)."""
    days = explode_business_days(groups.select("group_id"), start, end, "obs_date")
    hol = holidays.select(F.col(holidays.columns[0]).cast("date").alias("obs_date")).distinct()
    return days.join(hol, "obs_date", "left_anti")


def month_ends(calendars: DataFrame, start, end) -> DataFrame:
    """R2: (calendar, no, month, after, month_end): the last business day of every month of ``[start, end]``.

    ``calendars(calendar, holiday)`` holds the holidays of each calendar; a calendar without any has one row
    with a null. Business days are weekdays that are no holiday; a month without one has no row. ``no``
    counts a calendar's months from 1, ``after`` is the month end before (null for the first). The table
    has one row per calendar and month; the first and the last month are taken whole.
    """
    cal = calendars.select(F.col("calendar"), F.col("holiday").cast("date").alias("day"))
    span = cal.select("calendar").distinct().select(
        "calendar", F.trunc(date_value(start), "MM").alias("_s"), F.last_day(date_value(end)).alias("_e"))
    days = (span.select("calendar", F.explode(calendar_days(F.col("_s"), F.col("_e"))).alias("day"))
            .where(F.weekday("day") < 5).join(cal.where("day is not null").distinct(), ["calendar", "day"], "left_anti"))
    w = Window.partitionBy("calendar").orderBy("month")             # months of one calendar
    return (days.groupBy("calendar", F.trunc("day", "MM").alias("month")).agg(F.max("day").alias("month_end"))
            .select("calendar", F.row_number().over(w).alias("no"), "month",
                    F.lag("month_end").over(w).alias("after"), "month_end"))


def last_business_values(obs: DataFrame, ends: DataFrame, keys=("instrument_id",), *, date_col: str = "date",
                         value_col: str = "value", tiebreak=()) -> DataFrame:
    """R1 x R2: per key and month, the value as of the last business day of the key's calendar.

    ``obs`` has ``keys``, ``calendar``, a DATE and a value (null values count as observed); ``ends`` comes from
    :func:`month_ends`. The result has ``keys``, ``calendar``, ``month``, ``month_end``, ``as_of`` (the day of the
    observation taken: the last one on or before ``month_end``, in whatever month) and the value, for
    every month from a key's first observation to the first month end after its last one. Of several
    observations on a day the one with the greatest ``tiebreak`` columns counts. Observations with a null
    date or an unknown calendar, and those after the last month end, have no row of their own.

    The as-of join is an equi-join: an interval (month end before, month end] stands in the month buckets it
    touches, and an observation meets the one or two intervals of its own month. One partial
    aggregation by key and month follows; months without observations repeat the one before.
    """
    keys = list(keys)
    month = F.trunc(F.col(date_col), "MM")
    first = F.coalesce(F.trunc("after", "MM"), F.col("month"))
    buckets = ends.select(F.col("calendar").alias("_c"), "no", "after", "month_end", F.explode(
        F.sequence(first, F.col("month"), F.expr("INTERVAL 1 MONTH"))).alias("_bucket"))
    day = F.col(date_col)
    fits = (day <= F.col("month_end")) & (F.col("after").isNull() | (day > F.col("after")))
    base = obs.select(*keys, "calendar", F.col(date_col), F.col(value_col), *tiebreak, month.alias("_month"))
    met = base.join(buckets, (F.col("calendar") == F.col("_c")) & (F.col("_month") == F.col("_bucket"))).where(fits)
    last = met.groupBy(*keys, "calendar", "no").agg(F.max_by(
        F.struct(F.col(date_col).alias("as_of"), F.col(value_col).alias(value_col)), F.struct(date_col, *tiebreak)).alias("_v"))
    w = Window.partitionBy(*keys, "calendar").orderBy("no")         # at most one row per month of a key
    filled = last.withColumn("_to", F.coalesce(F.lead("no").over(w) - 1, F.col("no"))).select(
        *keys, F.col("calendar"), "_v", F.explode(F.sequence("no", "_to")).alias("no"))
    return filled.join(ends.select("calendar", "no", "month", "month_end"), ["calendar", "no"]).select(
        *keys, "calendar", "month", "month_end", F.col("_v.as_of").alias("as_of"), F.col("_v")[value_col].alias(value_col))


def null_treatment(obs: DataFrame, mode: str = "NA_NOTHING", value_col: str = "value") -> DataFrame:
    """``NA_NOTHING`` keeps NULL values (identity); ``drop`` removes them."""
    if mode == "NA_NOTHING":
        return obs
    if mode == "drop":
        return obs.filter(F.col(value_col).isNotNull())
    raise ValueError(f"unknown nan treatment {mode!r}")
