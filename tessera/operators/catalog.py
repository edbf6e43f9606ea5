"""Catalog operators: decomposition, search, dedupe, series selection.

Instrument names are pipe-delimited: ``_ | _ | series | _ | dataset | frequency | adjustment |
unit``. Selecting instruments for a list of requested series tests whether ``'| s |'`` occurs in
the name; that is a theta join (nested loop in Spark). We rewrite it exactly as an equi-join.
Split ``' s '`` on pipes into parts ``q0..qk`` (k = 0 for the usual pipe-free series). Then
``'| s |'`` occurs iff some *inner* segments (neither first nor last) ``i..i+k`` equal
``q0..qk``. So the catalog is exploded into (position, inner segment), hash-joined to the
requests on ``segment = q0``, and the remaining parts are checked by array equality.
"""
from __future__ import annotations

import re

from pyspark.sql import DataFrame, functions as F

from tessera.functions.text import inner_segments, pipe_segment

# Segment positions of the derived catalog columns (0-based).
SEGMENTS = {"series": 2, "dataset": 4, "frequency": 5, "adjustment": 6, "unit": 7}


def decompose(raw: DataFrame, name_col: str = "name") -> DataFrame:
    """Add series, dataset, frequency, adjustment and unit cut from the name."""
    return raw.select("*", *[pipe_segment(F.col(name_col), k).alias(c) for c, k in SEGMENTS.items()])


def dedupe_by_id(raw: DataFrame, id_col: str = "instrument_id") -> DataFrame:
    """One row per id (deterministically the smallest name)."""
    others = [c for c in raw.columns if c != id_col]
    best = F.min(F.struct(*others)).alias("_r")
    return raw.groupBy(id_col).agg(best).select(id_col, *[F.col("_r")[c].alias(c) for c in others])


def _has_keywords(keywords: str, name_col: str = "name"):
    cond = F.lit(True)
    for w in keywords.split():
        cond = cond & F.lower(F.col(name_col)).contains(w.lower())
    return cond


def keyword_search(raw: DataFrame, keywords: str, name_col: str = "name") -> DataFrame:
    """S3: instruments whose name contains every keyword (case-insensitive)."""
    return raw.filter(_has_keywords(keywords, name_col))


def search_union(raw: DataFrame, keyword_sets, id_col: str = "instrument_id") -> DataFrame:
    """S3 + U1 + A7: several searches in one scan, one row per instrument id."""
    cond = F.lit(False)
    for kw in keyword_sets:
        cond = cond | _has_keywords(kw)
    return dedupe_by_id(raw.filter(cond), id_col)


def instrument_catalog(raw: DataFrame, keyword_sets=None) -> DataFrame:
    """S5 body: (optionally searched) raw instruments, deduped by id, decomposed."""
    base = search_union(raw, keyword_sets) if keyword_sets else dedupe_by_id(raw)
    return decompose(base)


def filter_name(cat: DataFrame, pattern: str, *, literal: bool = False, name_col: str = "name") -> DataFrame:
    """Case-insensitive regex match on the name (``literal`` escapes the pattern)."""
    if not pattern:
        return cat
    pat = re.escape(pattern) if literal else pattern
    return cat.filter(F.col(name_col).rlike("(?i)" + pat))


def select_series(cat: DataFrame, requests: DataFrame, unit: str | None = "Index", *,
                  few: bool = False) -> DataFrame:
    """J1 + P11: catalog rows matching a requested series as an inner name segment, with the
    requested unit and, when the request row carries one, a dataset regex.

    ``requests`` has ``series`` and optionally ``tier`` and ``dataset_regex``; the result has one
    row per (request, instrument).

    The exploded catalog is never the side that is broadcast or hashed: Spark would choose it by
    its compressed size, far below what it takes in memory. ``few`` says that the requests are a
    short fixed list (the curated tiers), which is then sent to every task; otherwise both sides
    are shuffled by segment.
    """
    req = requests
    if "dataset_regex" not in req.columns:
        req = req.withColumn("dataset_regex", F.lit(None).cast("string"))
    if "tier" not in req.columns:
        req = req.withColumn("tier", F.lit(None).cast("string"))
    req = req.select("tier", F.col("series").alias("requested"), "dataset_regex")
    c = cat if unit is None else cat.filter(F.col("unit") == unit)
    segs = c.select("*", inner_segments("name").alias("_inner")).select(
        "*", F.posexplode("_inner").alias("_pos", "_seg"))
    parts = F.split(F.concat(F.lit(" "), F.col("requested"), F.lit(" ")), "[|]")
    rq = req.select("*", parts.alias("_parts")).withColumn("_seg", F.col("_parts")[0])
    hit = segs.join(F.broadcast(rq) if few else rq.hint("shuffle_hash"), "_seg").filter(
        F.slice("_inner", F.col("_pos") + 1, F.size("_parts")) == F.col("_parts"))
    # an instrument can match one request at several positions: keep one row
    sel = hit.drop("_seg", "_inner", "_pos", "_parts").distinct()
    ok = F.col("dataset_regex").isNull() | F.expr("dataset RLIKE dataset_regex")
    return sel.filter(ok).drop("dataset_regex")


def missing_series(requests: DataFrame, selected: DataFrame) -> DataFrame:
    """J2 + U3: requested series (per tier) with no selected instrument of that series name."""
    keys = ["tier", "series"] if "tier" in requests.columns else ["series"]
    matched = selected.select(*keys).distinct()
    return requests.join(matched, keys, "left_anti")


def all_items_series(cat: DataFrame, unit: str = "Index", dataset: str = "Consumer Price Index - Japan",
                     prefix: str = "CPI - ") -> DataFrame:
    """P12 + U2: distinct series of the all-items tier (dataset regex, unit, series prefix)."""
    return (cat.filter(F.col("dataset").rlike(dataset) & (F.col("unit") == unit)
                       & F.col("series").startswith(prefix))
            .select("series").distinct())


def attach_catalog(obs: DataFrame, lookup: DataFrame) -> DataFrame:
    """Add series, dataset and instrument name to observations; unknown ids get ''."""
    lk = lookup.select("instrument_id", F.col("series").alias("_series"),
                       F.col("dataset").alias("_dataset"), F.col("name").alias("_name"))
    j = obs.join(lk, "instrument_id", "left")
    return j.select(*[c for c in obs.columns],
                    F.coalesce("_series", F.lit("")).alias("series"),
                    F.coalesce("_dataset", F.lit("")).alias("dataset"),
                    F.coalesce("_name", F.lit("")).alias("instrument_name"))
