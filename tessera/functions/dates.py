"""Date helpers.

Work-item days travel as compact ``YYYYMMDD`` text, observation dates as ISO text or DATE.
Everything is a Column expression; a date range becomes an array that is exploded per row, so
plans are generated inside tasks, never on the driver.
"""
from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, functions as F

from tessera.util import as_col


def date_value(v) -> Column:
    """A date bound: a DATE Column is used as is; Python dates and ``YYYYMMDD`` /
    ``YYYY-MM-DD`` text become literals (parsed once, on the driver, never per row)."""
    if isinstance(v, Column):
        return v
    if isinstance(v, _dt.datetime):
        return F.lit(v.date())
    if isinstance(v, _dt.date):
        return F.lit(v)
    t = str(v)
    fmt = "%Y%m%d" if len(t) == 8 else "%Y-%m-%d"
    return F.lit(_dt.datetime.strptime(t, fmt).date())


def parse_ymd(c) -> Column:
    """Compact ``YYYYMMDD`` text (or a DATE) -> DATE; unparsable -> NULL."""
    c = as_col(c)
    return F.coalesce(F.try_to_date(c.cast("string"), "yyyyMMdd"), F.try_to_date(c.cast("string")))


def compact(d) -> Column:
    """DATE -> ``YYYYMMDD`` (F4 for typed dates)."""
    return F.date_format(as_col(d), "yyyyMMdd")


def business_days(start, end) -> Column:
    """F1 + P22: weekdays in ``[start, end]`` inclusive (no holidays) as ARRAY<DATE>.

    ``start``/``end`` are DATE columns or date text (see :func:`date_value`). ``start > end``
    yields an empty array (an unguarded ``sequence`` would count downwards or raise).
    """
    s, e = date_value(start), date_value(end)
    days = F.sequence(s, e, F.expr("INTERVAL 1 DAY"))
    return F.when(s <= e, F.filter(days, lambda d: F.weekday(d) < 5)).otherwise(
        F.array().cast("array<date>"))


def calendar_days(start, end) -> Column:
    """All days of ``[start, end]`` as ARRAY<DATE>; empty when ``start > end`` (guarded)."""
    s, e = date_value(start), date_value(end)
    return F.when(s <= e, F.sequence(s, e, F.expr("INTERVAL 1 DAY"))).otherwise(
        F.array().cast("array<date>"))


def explode_business_days(df, start, end, alias: str = "obs_date"):
    """F1 in row form: one row per weekday of ``[start, end]`` for every row of ``df``.

    Works with scalar-subquery bounds (which Spark does not allow inside ``filter(array, ...)``).
    """
    # Bounds are projected once, then referenced by name: a scalar-subquery bound is planned
    # (and run) once instead of once per reference.
    cols = df.columns
    bounded = df.select("*", date_value(start).alias("_bd_start"), date_value(end).alias("_bd_end"))
    return (bounded.select(*cols, F.explode(calendar_days(F.col("_bd_start"), F.col("_bd_end"))).alias(alias))
            .filter(F.weekday(F.col(alias)) < 5))


def yesterday(asof) -> Column:
    """the day before ``asof`` as compact text (``asof`` is a parameter, not the clock)."""
    return compact(F.date_sub(parse_ymd(asof), 1))


def ymd_to_iso(ymd) -> Column:
    """``YYYYMMDD`` -> ``YYYY-MM-DD`` by slicing (first 4, next 2, rest)."""
    s = as_col(ymd).cast("string")
    return F.concat(F.substring(s, 1, 4), F.lit("-"), F.substring(s, 5, 2), F.lit("-"),
                    F.substr(s, F.lit(7)))


def iso_to_compact(iso) -> Column:
    """remove every dash."""
    return F.regexp_replace(as_col(iso).cast("string"), "-", "")


def months_back(end_ymd, months) -> Column:
    """first day of the month ``months`` before the month of ``end_ymd``, compact text.

    Only year and month of ``end_ymd`` are used (the day is never validated), as in the source.
    """
    s = as_col(end_ymd).cast("string")
    # month arithmetic on integers (floor division / pmod like Python's // and %), so even an
    # out-of-range month such as 13 rolls over instead of failing under ANSI mode
    total = (F.substring(s, 1, 4).try_cast("int") * 12 + F.substring(s, 5, 2).try_cast("int") - 1
             - as_col(months).cast("int"))
    return F.format_string("%04d%02d01", F.floor(total / 12).cast("int"), (F.pmod(total, F.lit(12)) + 1))


def next_day(ymd) -> Column:
    """the following calendar day, compact text."""
    return compact(F.date_add(parse_ymd(ymd), 1))


def default_start(asof, days: int = 730) -> Column:
    """``asof`` minus ``days`` (730 by default) as compact text."""
    return compact(F.date_sub(parse_ymd(asof), days))


def run_ts_text(ts) -> Column:
    """``YYYYMMDDTHHMMSS`` of a timestamp (session time zone is UTC)."""
    return F.date_format(as_col(ts), "yyyyMMdd'T'HHmmss")


def norm_date(raw) -> Column:
    """Normalise a raw point date to ISO text.

    NULL -> NULL; exactly 8 digits -> parsed as ``yyyyMMdd`` (an impossible date such as
    ``20241301`` gives NULL, and the caller routes the row to rejects); length >= 10 -> first 10
    characters; anything else is returned unchanged.
    """
    t = as_col(raw).cast("string")
    return (F.when(t.isNull(), F.lit(None).cast("string"))
            .when(t.rlike("^[0-9]{8}$"),
                  F.date_format(F.try_to_date(t, "yyyyMMdd"), "yyyy-MM-dd"))
            .when(F.length(t) >= 10, F.substring(t, 1, 10))
            .otherwise(t))


def lenient_date(text) -> Column:
    """ISO text -> DATE, bad input -> NULL (never raises under ANSI mode)."""
    return F.try_to_date(as_col(text).cast("string"), "yyyy-MM-dd")


def lenient_timestamp(text) -> Column:
    """ISO timestamp text -> TIMESTAMP, bad input -> NULL."""
    return F.try_to_timestamp(as_col(text).cast("string"))
