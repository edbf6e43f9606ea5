"""Group-day extraction over landed pages.

The source calls the vendor once per (group, day) with every attribute, and when that comes back
empty, once per chunk of 10 attributes. Here both kinds of response are landed pages tagged
``request = 'full' | 'chunk:<n>'``; the choice "full rows if any, else the chunks" becomes one
anti join of the chunk pages on the pair key, evaluated for all pairs at once.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tessera.functions.text import truthy_first
from tessera.operators.flatten import discover_attributes, flatten_pages, has_usable_point  # noqa: F401  (re-exported)

PAIR = ["group_id", "obs_date"]


def attribute_chunks(attributes: DataFrame, chunk_size: int = 10) -> DataFrame:
    """Chunk number per discovered attribute, ``floor((position - 1) / n)``.

    ``attributes`` is already one row per (group, attribute) with a 1-based ``position``
    (see :func:`discover_attributes`), so the numbering needs no window over raw rows.
    """
    return attributes.withColumn("chunk_no", F.floor((F.col("position") - 1) / chunk_size).cast("int"))


def choose_pages(pages: DataFrame) -> DataFrame:
    """X1 on pages: the ``full`` pages (untagged pages count as full), and the ``chunk:`` pages of
    pairs whose full pages hold no usable point. One flag per page decides. Only chunk pages meet the answered
    pairs in a join; the full pages, nearly all of the data, go straight through."""
    request = F.coalesce(F.col("request"), F.lit("full"))
    full = pages.filter(request == "full")
    answered = full.filter(has_usable_point()).select(*PAIR).distinct()
    chunks = pages.filter(request.startswith("chunk:")).join(answered, PAIR, "left_anti")
    return full.unionByName(chunks.select(*pages.columns))


def extract_group_days(pages: DataFrame, *, keep_rejects: bool = False) -> DataFrame:
    """Strict rows per pair from the ``full`` request, or from its chunks when the full
    request returned nothing usable for that pair. One flatten over the chosen pages."""
    return flatten_pages(choose_pages(pages), keep_rejects=keep_rejects)


def restrict_instruments(rows: DataFrame, search_ids: DataFrame, key: str = "instrument") -> DataFrame:
    """Keep rows whose instrument is among the searched ids (semi join; AQE broadcasts the id
    list if its measured size is small)."""
    ids = search_ids.select(F.col(search_ids.columns[0]).alias(key)).distinct()
    return rows.join(ids, key, "left_semi")


def light_extract(pages: DataFrame, search_ids: DataFrame | None = None) -> DataFrame:
    """Light rows from chunked requests, optionally restricted to searched instruments (``None``:
    no restriction; an empty search: no rows, unlike the source, which then returned everything).

    The restriction is applied by instrument id (the server-side filter of the source), so it
    is done on the strict instrument key before light names (which keep blanks) are used.
    """
    request = F.coalesce(F.col("request"), F.lit("full"))
    chunks = pages.filter(request.startswith("chunk:"))
    # chunk responses; a pair that has none (a vendor page without a tag) is read from its full pages
    rest = pages.filter(request == "full").join(chunks.select(*PAIR).distinct(), PAIR, "left_anti")
    chunked = chunks.unionByName(rest.select(*pages.columns))
    if search_ids is not None:
        keyed = chunked.select("*", F.explode("instruments").alias("_i"))
        key = truthy_first(F.col("_i.instrument_id"), F.col("_i.instrument_name"))
        ids = search_ids.select(F.col(search_ids.columns[0]).alias("_key")).distinct()
        keyed = keyed.withColumn("_key", key).join(ids, "_key", "left_semi")
        chunked = keyed.withColumn("instruments", F.array("_i")).drop("_i", "_key")
    return flatten_pages(chunked, "light")


__all__ = ["attribute_chunks", "extract_group_days", "restrict_instruments",
           "light_extract", "discover_attributes"]
