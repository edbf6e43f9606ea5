"""Nested response pages -> long-form observations.

A page row holds ``instruments[] -> attributes[] -> time_series[] | series[]``; a point is an
object ``{date|obs_date|time, value}``, a pair ``[date, value]`` or junk. Points are VARIANT, and
three generator steps (``explode``) turn each page into rows inside the task that read it: no
shuffle, no Python.

Three profiles share one implementation:

* ``strict`` — bronze rows: names fall back name -> id -> name -> ``UNKNOWN`` skipping blanks;
  dates are normalised (P6) and rows without a date dropped; ``obs_date`` defaults to the date.
* ``light`` — ad-hoc lookup rows: Python ``or`` fallbacks (blank names kept, no ``name``
  fallback for attributes), date is the first 10 characters of the text (``None`` for null).
* ``cpi`` — price rows: instrument id only, ``date|time``, NULL values dropped, value as DOUBLE.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tessera.functions.dates import lenient_date, lenient_timestamp, norm_date, parse_ymd
from tessera.functions.text import first_present, truthy_first

PROFILES = ("strict", "light", "cpi")


def _vget(p: Column, path: str, typ: str = "string") -> Column:
    return F.try_variant_get(p, path, typ)


def _is_object(p: Column) -> Column:
    return _vget(p, "$", "map<string,variant>").isNotNull()


def _is_pair(p: Column) -> Column:
    # P20: lists shorter than two elements are junk, like scalars.
    return F.coalesce(F.size(_vget(p, "$", "array<variant>")) >= 2, F.lit(False))


def _py_str(c: Column) -> Column:
    """``str(x)`` for a possibly NULL text: NULL renders as ``None``."""
    return F.coalesce(c, F.lit("None"))


def _points(pages: DataFrame, profile: str, page_cap: int | None) -> DataFrame:
    """pages -> one row per (page, instrument, attribute, raw point)."""
    if page_cap is not None:
        # T4: the first page plus at most ``page_cap`` following pages.
        pages = pages.filter(F.coalesce(F.col("page_no"), F.lit(0)) <= page_cap)
    if profile == "strict":
        # page-level values are parsed once per page, not once per exploded point
        pages = pages.select("group_id", "instruments",
                             parse_ymd(F.col("obs_date")).alias("obs_date"),
                             lenient_timestamp(F.col("ingested_at")).alias("ingested_at"))
    inst = pages.select(
        "group_id", "obs_date", "ingested_at",
        F.explode("instruments").alias("i"))
    i = F.col("i")
    if profile == "strict":
        instrument = first_present(i["instrument_name"], i["instrument_id"], i["name"], F.lit("UNKNOWN"))
    elif profile == "light":
        instrument = truthy_first(i["instrument_name"], i["instrument_id"], F.lit("UNKNOWN"))
    else:
        instrument = _py_str(i["instrument_id"])
    attrs = inst.select("group_id", "obs_date", "ingested_at", instrument.alias("instrument"),
                        F.explode(i["attributes"]).alias("a"))
    a = F.col("a")
    if profile == "strict":
        attribute = first_present(a["attribute_id"], a["attribute"], a["name"], F.lit("UNKNOWN"))
        # first-present skips NULL but not an empty list: an empty time_series hides series
        series = F.coalesce(a["time_series"], a["series"])
    elif profile == "light":
        attribute = truthy_first(a["attribute_id"], a["attribute"], F.lit("UNKNOWN"))
        series = F.when(F.size(a["time_series"]) > 0, a["time_series"]).otherwise(a["series"])
    else:
        attribute = F.lit("NO_ATTRIBUTE")
        series = a["time_series"]
    return attrs.select("group_id", "obs_date", "ingested_at", "instrument",
                        attribute.alias("attribute"), F.explode(series).alias("p"))


def has_usable_point(profile: str = "strict") -> Column:
    """Page level: does any point of the page give a strict row (dated, and the date is possible)?"""
    def usable(p):
        date = (F.when(_is_object(p), first_present(_vget(p, "$.date"), _vget(p, "$.obs_date"), _vget(p, "$.time")))
                .when(_is_pair(p), _vget(p, "$[0]")))
        possible = ~date.rlike("^[0-9]{8}$") | norm_date(date).isNotNull()
        known_day = parse_ymd(F.col("obs_date")).isNotNull() | lenient_date(norm_date(date)).isNotNull()
        return F.coalesce(date.isNotNull() & possible & known_day, F.lit(False))

    def attribute(a):
        return F.coalesce(F.exists(F.coalesce(a["time_series"], a["series"]), usable), F.lit(False))

    def instrument(i):
        return F.coalesce(F.exists(i["attributes"], attribute), F.lit(False))

    return F.coalesce(F.exists("instruments", instrument), F.lit(False))


def flatten_pages(pages: DataFrame, profile: str = "strict", *, page_cap: int | None = None,
                  keep_rejects: bool = False) -> DataFrame:
    """Explode response pages into observation rows.

    ``strict`` returns the bronze shape (7 columns, dates typed). With ``keep_rejects`` the
    strict profile also returns rows whose 8-digit date is impossible (the source would raise
    and lose the whole pair; we keep the rest and surface the row) or whose ``obs_date`` would
    be NULL (never a NULL partition key), flagged ``rejected``. The ``cpi`` profile's rejects are
    values that are no numbers.
    """
    if profile not in PROFILES:
        raise ValueError(f"profile must be one of {PROFILES}")
    pts = _points(pages, profile, page_cap)
    p = F.col("p")
    obj, pair = _is_object(p), _is_pair(p)
    if profile == "strict":
        raw_date = (F.when(obj, first_present(_vget(p, "$.date"), _vget(p, "$.obs_date"),
                                              _vget(p, "$.time")))
                    .when(pair, _vget(p, "$[0]")))
        raw_val = F.when(obj, _vget(p, "$.value")).when(pair, _vget(p, "$[1]"))
        rows = pts.filter(obj | pair).select(
            "group_id", "instrument", "attribute",
            raw_date.alias("raw_date"), norm_date(raw_date).alias("date_text"),
            raw_val.alias("value"), "obs_date", "ingested_at")
        rows = rows.filter(F.col("raw_date").isNotNull())
        typed_date = lenient_date(F.col("date_text"))
        obs_date = F.coalesce(F.col("obs_date"), typed_date)
        # rejects: impossible 8-digit dates, and rows that would get a NULL partition key
        rejected = (F.col("raw_date").rlike("^[0-9]{8}$") & F.col("date_text").isNull()) | obs_date.isNull()
        out = rows.select(
            "group_id", "instrument", "attribute", typed_date.alias("date"), "value",
            obs_date.alias("obs_date"), "ingested_at",
            rejected.alias("rejected"))
        if keep_rejects:
            return out
        return out.filter(~F.col("rejected")).drop("rejected")
    if profile == "light":
        raw_date = (F.when(obj, truthy_first(_vget(p, "$.date"), _vget(p, "$.obs_date"),
                                             _vget(p, "$.time")))
                    .when(pair, _vget(p, "$[0]")))
        raw_val = F.when(obj, _vget(p, "$.value")).when(pair, _vget(p, "$[1]"))
        return pts.filter(obj | pair).select(
            "instrument", "attribute",
            F.substring(_py_str(raw_date), 1, 10).alias("date"), raw_val.alias("value"))
    # cpi: a place of a list and a field of an object are NULL on every point of another shape, so
    # one look at each decides (pairs before objects, as in the source) and no point is cast whole.
    # NULL values are dropped (P13); a value of either kind shows that the point is a pair or an object.
    raw_date = F.coalesce(_vget(p, "$[0]"), truthy_first(_vget(p, "$.date"), _vget(p, "$.time")))
    value = F.coalesce(_vget(p, "$[1]", "double"), _vget(p, "$.value", "double"))
    fields = [F.substring(_py_str(raw_date), 1, 10).alias("date"), value.alias("value")]
    if keep_rejects:
        fields.append(F.coalesce(_vget(p, "$[1]"), _vget(p, "$.value")).alias("value_text"))
    # Decoded once per point, in a generator of one row: Spark would copy the decoding into every
    # filter above a plain projection (a caller's date window, too).
    rows = pts.select(F.col("instrument").alias("instrument_id"), F.inline(F.array(F.struct(*fields))))
    # a text that is no number is a reject, like an impossible date: never a NULL value row
    if keep_rejects:
        return (rows.filter(F.col("value_text").isNotNull())
                .select("date", "instrument_id", "value", F.col("value").isNull().alias("rejected")))
    return rows.filter(F.col("value").isNotNull()).select("date", "instrument_id", "value")


def discover_attributes(pages: DataFrame, profile: str = "strict",
                        *, page_cap: int | None = None) -> DataFrame:
    """P4 + P15: distinct attribute ids per group in first-seen order.

    Blank ids and composite ids (containing a comma) are skipped. "First seen" is the smallest
    (page_no, instrument position, attribute position); it is found with a grouped ``min`` —
    partial aggregation folds each group map-side, so a hot group never lands whole in one task.
    Returns ``group_id, attribute, position`` (1-based).
    """
    if page_cap is not None:
        pages = pages.filter(F.coalesce(F.col("page_no"), F.lit(0)) <= page_cap)
    inst = pages.select("group_id", F.coalesce("page_no", F.lit(0)).alias("page_no"),
                        F.posexplode("instruments").alias("ipos", "i"))
    attrs = inst.select("group_id", "page_no", "ipos",
                        F.posexplode(F.col("i")["attributes"]).alias("apos", "a"))
    a = F.col("a")
    if profile == "strict":
        aid = first_present(a["attribute_id"], a["attribute"], a["name"])
    else:
        aid = truthy_first(a["attribute_id"], a["attribute"], a["name"])
    ids = (attrs.select("group_id", aid.alias("attribute"),
                        F.struct("page_no", "ipos", "apos").alias("seen"))
           .filter(F.col("attribute").isNotNull() & ~F.col("attribute").contains(",")))
    first = ids.groupBy("group_id", "attribute").agg(F.min("seen").alias("seen"))
    # The window runs over distinct (group, attribute) pairs only.
    from pyspark.sql import Window
    w = Window.partitionBy("group_id").orderBy("seen", "attribute")
    return first.select("group_id", "attribute",
                        F.row_number().over(w).cast("long").alias("position"))
