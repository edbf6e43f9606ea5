"""Catalog and tier queries: S3-S5, P7-P12, P16, A7, A8, J1-J3, X8, X9, T2, T3, K5."""
from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import catalog as C
from tessera.queries import analogues as A
from tessera.plans import tiers
from tessera.plans.curated import ALL_CURATED, tier_rows
from tessera.queries.q_flatten import land_price_pages
from tessera.operators.flatten import flatten_pages
from tessera.registry import query
from tessera.sources.catalog import cached_catalog
from tessera.session import read_table, scratch_dir
from tessera.sources.search import build_index, search_index
from tessera.sources import catalog as S


def _sq(s):
    return "NULL" if s is None else "'" + s.replace("'", "''") + "'"


REQ_SQL = "req(tier, series, req_pos, dataset_regex) AS (VALUES " + ", ".join(
    f"({_sq(t)}, {_sq(s)}, {p}, CAST({_sq(rx)} AS VARCHAR))" for t, s, p, rx in tier_rows()) + ")"
ALLREQ_SQL = """allreq AS (SELECT * FROM req UNION ALL
  SELECT DISTINCT 'all_items', series, CAST(NULL AS INTEGER), 'Japan' FROM v3c
  WHERE regexp_matches(dataset, 'Consumer Price Index - Japan') AND unit = 'Index' AND starts_with(series, 'CPI - '))"""
SEL_SQL = """sel AS (SELECT r.tier, r.series AS requested, c.* FROM v3c c JOIN {req} r
  ON contains(c.name, '| ' || r.series || ' |')
  WHERE c.unit = 'Index' AND (r.dataset_regex IS NULL OR regexp_matches(c.dataset, r.dataset_regex)))"""


def catalog(spark, sf_dir):
    """The catalog, materialised once per query and read back."""
    return cached_catalog(spark, scratch_dir(spark, "catalog"),
                          lambda: C.instrument_catalog(A.catalog_names(spark, sf_dir)))


@query("p7_pipe_segments", A.with_views("v3c") + "SELECT * FROM v3c")
def segments_q(spark, sf_dir):
    return C.decompose(A.catalog_names(spark, sf_dir))


@query("a7_dedupe_instruments", A.with_views("v3") + """
SELECT instrument_id, min(name) AS name FROM (SELECT * FROM v3 UNION ALL SELECT instrument_id, name || ' | stale' FROM v3)
GROUP BY instrument_id""")
def dedupe_q(spark, sf_dir):
    raw = A.catalog_names(spark, sf_dir)
    doubled = raw.unionByName(raw.select("instrument_id", F.concat("name", F.lit(" | stale")).alias("name")))
    return C.dedupe_by_id(doubled)


@query("s3_instrument_search", A.with_views("v3") + """
SELECT DISTINCT instrument_id, name FROM v3
WHERE (contains(lower(name), 'japan') AND contains(lower(name), 'cpi'))
   OR (contains(lower(name), 'tokyo') AND contains(lower(name), 'cpi'))""")
def search_q(spark, sf_dir):
    return C.search_union(A.catalog_names(spark, sf_dir), ["Japan CPI", "Tokyo CPI"])


@query("s3_index_search", A.with_views("v3") + """
SELECT DISTINCT instrument_id, name FROM v3
WHERE (contains(lower(name), 'japan') AND contains(lower(name), 'cpi') AND contains(lower(name), 'foo'))
   OR (contains(lower(name), 'tokyo') AND contains(lower(name), 'ener'))""")
def index_search_q(spark, sf_dir):
    """The search over a stored word index; parts of words count, as in the scan."""
    path = build_index(spark, A.catalog_names(spark, sf_dir), scratch_dir(spark, "word-index"))
    return search_index(spark, path, ["Japan CPI foo", "Tokyo ENER"])


@query("s5_instrument_catalog", A.with_views("v3c") + "SELECT * FROM v3c")
def cached_catalog_q(spark, sf_dir):
    path = scratch_dir(spark, "instrument-catalog")
    S.cached_catalog(spark, path, lambda: catalog(spark, sf_dir))          # builds and writes
    return S.cached_catalog(spark, path, lambda: catalog(spark, sf_dir))   # reads the cache


@query("p8_regex_filter", A.with_views("v3c") + """
SELECT * FROM v3c WHERE regexp_matches(name, '(?i)tokyo - all')""")
def regex_filter_q(spark, sf_dir):
    return C.filter_name(catalog(spark, sf_dir), "tokyo - all")


def _group_snapshot(spark, sf_dir):
    n = read_table(spark, sf_dir, "nation")
    r = read_table(spark, sf_dir, "region")
    return n.join(r, n.n_regionkey == r.r_regionkey).select(
        F.col("n_name").alias("group_id"),
        F.concat(F.lit("Group "), F.col("n_nationkey").cast("string")).alias("group_name"),
        F.concat(F.lit("Nation group in "), F.col("r_name")).alias("description"))


_SNAP_SQL = """snap AS (SELECT n_name AS group_id, 'Group ' || CAST(n_nationkey AS VARCHAR) AS name,
  'Nation group in ' || r_name AS description FROM nation JOIN region ON n_regionkey = r_regionkey)"""


@query("s4_group_catalog", f"WITH {_SNAP_SQL} SELECT * FROM snap")
def group_catalog_q(spark, sf_dir):
    return S.group_catalog(_group_snapshot(spark, sf_dir))


@query("p9_group_search", f"""WITH {_SNAP_SQL}
SELECT * FROM snap WHERE regexp_matches(lower(group_id), 'nation_1') OR regexp_matches(lower(name), 'nation_1')""")
def group_search_q(spark, sf_dir):
    return S.search_groups(S.group_catalog(_group_snapshot(spark, sf_dir)), "NATION_1")


@query("a8_listing_dedupe", """
SELECT group_id, name, description FROM (
  SELECT *, row_number() OVER (PARTITION BY group_id ORDER BY pos) AS rn FROM (
    SELECT c_custkey AS pos,
           CASE WHEN c_custkey % 11 = 0 THEN '' ELSE 'G' || CAST(c_custkey % 97 AS VARCHAR) END AS group_id,
           c_name AS name, c_mktsegment AS description FROM customer)
  WHERE group_id <> '') WHERE rn = 1""")
def listing_dedupe_q(spark, sf_dir):
    return S.dedupe_listing(_live_listing(spark, sf_dir))


def _live_listing(spark, sf_dir):
    c = read_table(spark, sf_dir, "customer")
    return c.select(F.col("c_custkey").alias("pos"),
                       F.when(F.col("c_custkey") % 11 == 0, F.lit(""))
                        .otherwise(F.concat(F.lit("G"), (F.col("c_custkey") % 97).cast("string"))).alias("group_id"),
                       F.col("c_name").alias("group_name"), F.col("c_mktsegment").alias("description"))


@query("s4_live_fallback", """
SELECT group_id, name, description FROM (
  SELECT *, row_number() OVER (PARTITION BY group_id ORDER BY pos) AS rn FROM (
    SELECT c_custkey AS pos,
           CASE WHEN c_custkey % 11 = 0 THEN '' ELSE 'G' || CAST(c_custkey % 97 AS VARCHAR) END AS group_id,
           c_name AS name, c_mktsegment AS description FROM customer)
  WHERE group_id <> '') WHERE rn = 1 AND (contains(lower(group_id), 'g1') OR contains(lower(name), 'g1'))""")
def live_fallback_q(spark, sf_dir):
    """No snapshot yet: the live listing answers, then the search filter."""
    return S.list_groups(spark, scratch_dir(spark, "no-snapshot"), lambda: _live_listing(spark, sf_dir), "G1")


@query("p10_multi_literal", A.with_views("v3c") + f"""
SELECT instrument_id, name FROM v3c
WHERE EXISTS (SELECT 1 FROM unnest({A._sql_list(ALL_CURATED)}) t(s) WHERE contains(name, '| ' || s || ' |'))""")
def multi_literal_q(spark, sf_dir):
    req = tiers.curated_requests(spark).select("series")
    return C.select_series(catalog(spark, sf_dir), req, unit=None, few=True).select("instrument_id", "name").distinct()


@query("j1_series_semi", A.with_views("v3c") + f", {REQ_SQL}, " + SEL_SQL.format(req="req") + """
SELECT tier, requested, instrument_id, series, dataset FROM sel""")
def series_semi_q(spark, sf_dir):
    sel = C.select_series(catalog(spark, sf_dir), tiers.curated_requests(spark), few=True)
    return sel.select("tier", "requested", "instrument_id", "series", "dataset")


@query("j2_missing_series", A.with_views("v3c") + f", {REQ_SQL}, " + SEL_SQL.format(req="req") + """
SELECT tier, series, req_pos FROM req r
WHERE NOT EXISTS (SELECT 1 FROM sel WHERE sel.tier = r.tier AND sel.series = r.series)""")
def missing_q(spark, sf_dir):
    req = tiers.curated_requests(spark)
    sel = C.select_series(catalog(spark, sf_dir), req, few=True)
    return C.missing_series(req.select("tier", "series", "req_pos"), sel.select("tier", "series"))


@query("t3_first_missing", A.with_views("v3c") + f", {REQ_SQL}, " + SEL_SQL.format(req="req") + """,
miss AS (SELECT tier, series, req_pos FROM req r
         WHERE NOT EXISTS (SELECT 1 FROM sel WHERE sel.tier = r.tier AND sel.series = r.series))
SELECT tier, series, req_pos, n_missing FROM (
  SELECT *, row_number() OVER (PARTITION BY tier ORDER BY req_pos) AS rk,
         COUNT(*) OVER (PARTITION BY tier) AS n_missing FROM miss) WHERE rk <= 5""")
def first_missing_q(spark, sf_dir):
    req = tiers.curated_requests(spark)
    sel = C.select_series(catalog(spark, sf_dir), req, few=True)
    return tiers.first_missing(req, sel.select("tier", "series"))


@query("p11_unit_dataset_filter", A.with_views("v3c") + """
SELECT * FROM v3c WHERE unit = 'Index' AND regexp_matches(dataset, 'Japan')""")
def unit_dataset_q(spark, sf_dir):
    cat = catalog(spark, sf_dir)
    return cat.filter((F.col("unit") == "Index") & F.col("dataset").rlike("Japan"))


@query("p12_all_items_series", A.with_views("v3c") + """
SELECT DISTINCT series FROM v3c WHERE regexp_matches(dataset, 'Consumer Price Index - Japan')
  AND unit = 'Index' AND starts_with(series, 'CPI - ')""")
def all_items_q(spark, sf_dir):
    return C.all_items_series(catalog(spark, sf_dir))


@query("j3_obs_catalog_left", A.with_views("v3c", "v6") + """
SELECT o.date, o.instrument_id, o.value, coalesce(c.series, '') AS series, coalesce(c.dataset, '') AS dataset,
       coalesce(c.name, '') AS instrument_name
FROM (SELECT date, instrument_id, value FROM v6 WHERE value IS NOT NULL) o
LEFT JOIN (SELECT * FROM v3c WHERE unit = 'Index') c USING (instrument_id)""")
def attach_q(spark, sf_dir):
    obs = A.price_points(spark, sf_dir).filter(F.col("value").isNotNull()).select("date", "instrument_id", "value")
    lookup = catalog(spark, sf_dir).filter(F.col("unit") == "Index")
    return C.attach_catalog(obs, lookup)


def _end_ymd(spark, sf_dir):
    """The run's end date, a scalar parameter (the last ship day), fetched once. ``max`` on the
    bare column can be answered from Parquet footers (aggregate pushdown)."""
    li = read_table(spark, sf_dir, "lineitem")
    return li.agg(F.max("l_shipdate")).first()[0].strftime("%Y%m%d")


_END_SQL = "lim AS (SELECT max(CAST(l_shipdate AS DATE)) AS e FROM lineitem)"


def _fetch_sql(req: str, months: int) -> str:
    return f"""SELECT s.tier, o.date, o.instrument_id, s.series, s.dataset, 'Index' AS unit, o.value,
       s.name AS instrument_name
FROM (SELECT date, instrument_id, value FROM v6 WHERE value IS NOT NULL) o
JOIN sel s USING (instrument_id)
WHERE o.date >= strftime(date_trunc('month', (SELECT e FROM lim)) - INTERVAL {months} MONTH, '%Y-%m-%d')
  AND o.date <= strftime((SELECT e FROM lim), '%Y-%m-%d')"""


_X8_SQL = (A.with_views("v3c", "v6") + f", {REQ_SQL}, {_END_SQL}, mreq AS (SELECT * FROM req WHERE tier = 'main_categories'), "
           + SEL_SQL.format(req="mreq") + "\n" + _fetch_sql("mreq", 6))


def _main_fetch(spark, sf_dir):
    req = tiers.curated_requests(spark).filter(F.col("tier") == "main_categories")
    obs = flatten_pages(land_price_pages(spark, sf_dir), "cpi")
    return tiers.fetch_series(obs, catalog(spark, sf_dir), req, _end_ymd(spark, sf_dir), months=6, few=True)


@query("x8_series_fetch", _X8_SQL)
def series_fetch_q(spark, sf_dir):
    return _main_fetch(spark, sf_dir)


@query("x9_all_tiers", A.with_views("v3c", "v6") + f", {REQ_SQL}, {ALLREQ_SQL}, {_END_SQL}, "
       + SEL_SQL.format(req="allreq") + "\n" + _fetch_sql("allreq", 84))
def tiers_q(spark, sf_dir):
    cat = catalog(spark, sf_dir)
    obs = flatten_pages(land_price_pages(spark, sf_dir), "cpi")
    return tiers.fetch_series(obs, cat, tiers.tier_requests(spark, cat), _end_ymd(spark, sf_dir), months=84)


@query("t1_sorted_fetch", _X8_SQL)
def sorted_fetch_q(spark, sf_dir):
    return tiers.sort_rows(_main_fetch(spark, sf_dir))


@query("t2_preview", f"""SELECT * FROM ({_X8_SQL}) ORDER BY series, dataset, date, instrument_id, value LIMIT 10""")
def preview_q(spark, sf_dir):
    return tiers.preview(_main_fetch(spark, sf_dir), 10)


@query("k5_tier_snapshot", _X8_SQL)
def snapshot_q(spark, sf_dir):
    root = scratch_dir(spark, "tiers")
    end = "latest"
    path = tiers.save_snapshot(_main_fetch(spark, sf_dir), root, "main_categories", end)
    return spark.read.parquet(path)
