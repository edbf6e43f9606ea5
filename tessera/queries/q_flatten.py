"""Flatten / page queries: S1, S2, P1-P4, P13, P15, P20, T4, W1, X1, X10, J7."""
from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators.flatten import discover_attributes, flatten_pages
from tessera.queries import analogues as A
from tessera.plans import extract
from tessera.registry import query
from tessera.session import scratch_dir
from tessera.sources.pages import read_pages, write_pages


def _landed(spark, kind, pages):
    """Land a page set (JSON text rows) in a fresh folder and scan it."""
    return read_pages(spark, write_pages(pages, scratch_dir(spark, f"pages-{kind}")))


def land_observation_pages(spark, sf_dir, *, chunk_size: int | None = None, full_days: str = "all"):
    """Land V1 as response pages; returns the scanned page DataFrame.

    ``full_days='even'`` lands the full request only for even days of the month; with
    ``chunk_size`` every pair also gets one response per chunk of discovered attributes.
    """
    v1 = A.observations(spark, sf_dir, helpers=True)
    full_all = _landed(spark, "full", A.observation_pages(v1, request="full"))
    if not chunk_size:
        return full_all
    even = v1.filter(F.dayofmonth("date") % 2 == 0) if full_days == "even" else v1
    # Attribute discovery runs on the full responses of *all* pairs (the attribute listing
    # is per group, not per day); chunk requests then ask for discovered attributes only.
    attrs = extract.attribute_chunks(discover_attributes(full_all), chunk_size)
    rows = v1.join(attrs.select("group_id", "attribute", "chunk_no"), ["group_id", "attribute"])
    full = even.withColumn("request", F.lit("full"))
    chunks = rows.withColumn("request", F.concat(F.lit("chunk:"), F.col("chunk_no").cast("string")))
    both = full.unionByName(chunks.select(*full.columns))
    return _landed(spark, "chunked", A.observation_pages(both, request=F.col("request")))   # one landing job


@query("p1_flatten_strict", A.with_views("v1") + """
SELECT group_id, instrument, attribute, date, value, obs_date FROM v1""")
def flatten_strict_q(spark, sf_dir):
    return flatten_pages(land_observation_pages(spark, sf_dir)).drop("ingested_at")


_LIGHT_SQL = """SELECT CASE WHEN user_id % 3 = 2 THEN '  ' ELSE instrument END AS instrument,
       CASE WHEN attribute = 'DOVE_SCORE' THEN 'UNKNOWN' ELSE attribute END AS attribute,
       CASE WHEN event_id % 5 = 2 THEN strftime(date, '%Y%m%d') ELSE strftime(date, '%Y-%m-%d') END AS date,
       value"""


@query("p2_flatten_light", A.with_views("v1") + _LIGHT_SQL + " FROM v1")
def flatten_light_q(spark, sf_dir):
    return flatten_pages(land_observation_pages(spark, sf_dir), "light")


def land_price_pages(spark, sf_dir):
    return _landed(spark, "prices", A.price_pages(A.price_points(spark, sf_dir)))


@query("p3_flatten_cpi", A.with_views("v6") + """
SELECT date, instrument_id, value FROM v6 WHERE value IS NOT NULL""")
def flatten_cpi_q(spark, sf_dir):
    return flatten_pages(land_price_pages(spark, sf_dir), "cpi")


_SEEN_SQL = """seen AS (
  SELECT group_id, attribute,
         CAST(user_id // 16 AS INTEGER) AS page_no,
         CAST(dense_rank() OVER (PARTITION BY group_id, date, user_id // 16 ORDER BY instrument) - 1 AS INTEGER) AS ipos,
         CAST(dense_rank() OVER (PARTITION BY group_id, date, user_id ORDER BY attribute) - 1 AS INTEGER) AS apos
  FROM v1),
firsts AS (
  SELECT group_id, attribute, min((page_no, ipos, apos)) AS s FROM seen
  WHERE NOT contains(attribute, ',') GROUP BY group_id, attribute)"""


@query("p4_discover_attributes", A.with_views("v1") + ", " + _SEEN_SQL + """
SELECT group_id, attribute, row_number() OVER (PARTITION BY group_id ORDER BY s, attribute) AS position
FROM firsts""")
def discover_q(spark, sf_dir):
    return discover_attributes(land_observation_pages(spark, sf_dir))


@query("w1_chunk_assignment", A.with_views("v1") + ", " + _SEEN_SQL + """
SELECT group_id, attribute, position, CAST(floor((position - 1) / 2) AS INTEGER) AS chunk_no
FROM (SELECT group_id, attribute, row_number() OVER (PARTITION BY group_id ORDER BY s, attribute) AS position
      FROM firsts)""")
def chunks_q(spark, sf_dir):
    # chunk size 2 so the three discoverable attributes span two chunks
    return extract.attribute_chunks(discover_attributes(land_observation_pages(spark, sf_dir)), 2)


@query("s1_pages_scan", A.with_views("v1") + """
SELECT group_id, strftime(date, '%Y%m%d') AS obs_date, CAST(user_id // 16 AS INTEGER) AS page_no,
       CAST(COUNT(DISTINCT user_id) AS INTEGER) AS n_instruments
FROM v1 GROUP BY 1, 2, 3""")
def pages_scan_q(spark, sf_dir):
    pages = land_observation_pages(spark, sf_dir)
    return pages.select("group_id", "obs_date", "page_no", F.size("instruments").alias("n_instruments"))


@query("s2_attribute_pages", A.with_views("v1") + """
SELECT group_id, strftime(date, '%Y%m%d') AS obs_date, CAST(user_id // 16 AS INTEGER) AS page_no,
       CAST(COUNT(DISTINCT (user_id, attribute)) AS BIGINT) AS n_attribute_entries
FROM v1 GROUP BY 1, 2, 3""")
def attribute_pages_q(spark, sf_dir):
    pages = land_observation_pages(spark, sf_dir)
    entries = pages.select("group_id", "obs_date", "page_no", F.explode("instruments").alias("i")).select(
        "group_id", "obs_date", "page_no", F.size("i.attributes").alias("n"))
    return entries.groupBy("group_id", "obs_date", "page_no").agg(
        F.sum("n").cast("long").alias("n_attribute_entries"))


@query("p20_malformed_point_skip", A.with_views("v1") + """
SELECT group_id, COUNT(*) AS n_skipped
FROM (SELECT DISTINCT group_id, date, user_id, attribute FROM v1) GROUP BY group_id""")
def malformed_q(spark, sf_dir):
    from tessera.operators.flatten import _is_object, _is_pair, _points
    pts = _points(land_observation_pages(spark, sf_dir), "strict", None)
    p = F.col("p")
    return (pts.filter(~(_is_object(p) | _is_pair(p))).groupBy("group_id")
            .agg(F.count(F.lit(1)).alias("n_skipped")))


@query("t4_page_cap", A.with_views("v1") + """
SELECT group_id, instrument, attribute, date, value, obs_date FROM v1 WHERE user_id // 16 <= 2""")
def page_cap_q(spark, sf_dir):
    # Pages hold 16 instruments each; a cap of 2 following pages keeps pages 0..2.
    return flatten_pages(land_observation_pages(spark, sf_dir), page_cap=2).drop("ingested_at")


@query("x1_group_day_extract", A.with_views("v1") + """
SELECT group_id, instrument, attribute, date, value, obs_date FROM v1
WHERE day(date) % 2 = 0 OR NOT contains(attribute, ',')""")
def extract_q(spark, sf_dir):
    pages = land_observation_pages(spark, sf_dir, chunk_size=2, full_days="even")
    return extract.extract_group_days(pages).drop("ingested_at")


def _search_ids(spark, sf_dir):
    """Instrument search: ids whose text starts with 'U1' (the search is the feature)."""
    v1 = A.observations(spark, sf_dir)
    return v1.select("instrument").filter(F.col("instrument").startswith("U1")).distinct()


@query("x10_light_extract", A.with_views("v1") + _LIGHT_SQL + """ FROM v1
WHERE NOT contains(attribute, ',') AND starts_with(instrument, 'U1')""")
def light_extract_q(spark, sf_dir):
    pages = land_observation_pages(spark, sf_dir, chunk_size=2, full_days="even")
    return extract.light_extract(pages, _search_ids(spark, sf_dir))


@query("j7_instrument_restrict", A.with_views("v1") + """
SELECT group_id, instrument, attribute, date, value, obs_date FROM v1 WHERE starts_with(instrument, 'U1')""")
def restrict_q(spark, sf_dir):
    rows = flatten_pages(land_observation_pages(spark, sf_dir)).drop("ingested_at")
    return extract.restrict_instruments(rows, _search_ids(spark, sf_dir))
