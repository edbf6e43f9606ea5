"""Test-analogue views: the reference's data model derived from the driver tables.

Every view is defined twice, as a Spark DataFrame and as DuckDB SQL, so each registered query
can be checked against an independent oracle. The derivations use arithmetic on ids to spread
shapes and categories over the rows (never to drop rows), so the views grow with the tables.

* V1 observations  <- events   (one row per event)
* V2 manifest      <- events   (one row per user x day)
* V3 instrument catalog <- part (one row per part; names carry the curated series)
* V4 attempts      <- events   (one attempt record per event)
* V6 price observations <- lineitem (one point per line)
* V5 / V7 pages    <- V1 / V6 nested into JSON response pages (written, then scanned)
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tessera.plans.curated import ALL_CURATED
from tessera.session import read_table

# Fixed values (fixture design, ours): attribute names spread by event_id % 4.
ATTRIBUTES = ["SENTIMENT", "HAWK_SCORE", "DOVE_SCORE", "HAWK_SCORE,DOVE_SCORE"]
# Fixed values (fixture design, ours): catalog datasets spread by p_size % 3.
DATASETS = ["Consumer Price Index - Japan", "Consumer Price Index - Tokyo",
            "Producer Price Index - Japan"]
CATALOG_MOD = 131   # ids 0..112 take a curated series name, 113..130 a generic item name
# Fixed values (fixture design, ours): attempt messages by event_id % 12; every F8 branch.
MESSAGES = [
    "rows=5 instruments=2 attributes=3",
    "HTTPError: 429 Too Many Requests",
    "HTTPError: 401 Unauthorized",
    "ClientError: quota exceeded for client",
    "empty_payload: 0 rows returned",
    "TimeoutError: request timed out",
    "ConnectionError: connection reset by peer",
    "ValueError: validation failed for field obs_date",
    "RuntimeError: unexpected failure xyz",
    "volume_write_error: OSError: cannot write raw/obs__20240102.parquet",
    None,
    "rows=12 instruments=4 attributes=2",
]
RUN_TS = "20240201T000000"
PAGE_INGESTED_AT = "2024-02-01T00:00:00"


def _sql_str(s: str | None) -> str:
    return "NULL" if s is None else "'" + s.replace("'", "''") + "'"


def _sql_list(values) -> str:
    return "[" + ", ".join(_sql_str(v) for v in values) + "]"


# ---------------------------------------------------------------------------------------------
# V1 observations
# ---------------------------------------------------------------------------------------------

def observations(spark: SparkSession, sf_dir: str, *, helpers: bool = False) -> DataFrame:
    ev = read_table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    d = F.to_date("ts")
    attr = F.element_at(F.array(*[F.lit(a) for a in ATTRIBUTES]), (F.col("event_id") % 4 + 1).cast("int"))
    cols = [
        F.col("event_type").alias("group_id"),
        F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("instrument"),
        attr.alias("attribute"),
        d.alias("date"),
        F.when(F.col("event_id") % 50 == 0, F.lit(None).cast("string"))
         .otherwise(F.col("value").cast("decimal(18,2)").cast("string")).alias("value"),
        d.alias("obs_date"),
        F.col("ts").cast("timestamp").alias("ingested_at"),
    ]
    if helpers:
        cols += ["event_id", "user_id", F.col("ts").alias("ts")]
    return ev.select(*cols)


V1_SQL = f"""v1 AS (
  SELECT event_type AS group_id,
         'U' || CAST(user_id AS VARCHAR) AS instrument,
         {_sql_list(ATTRIBUTES)}[event_id % 4 + 1] AS attribute,
         CAST(ts AS DATE) AS date,
         CASE WHEN event_id % 50 = 0 THEN NULL
              ELSE CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) END AS value,
         CAST(ts AS DATE) AS obs_date,
         ts AS ingested_at, event_id, user_id, ts
  FROM events)"""


# ---------------------------------------------------------------------------------------------
# V2 manifest
# ---------------------------------------------------------------------------------------------

def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type")
    g = F.concat(F.lit("U"), F.col("user_id").cast("string"))
    agg = (ev.groupBy(g.alias("group_id"), F.to_date("ts").alias("obs_date"))
           .agg(F.count(F.lit(1)).alias("row_count"),
                F.countDistinct("event_type").alias("instrument_count"),
                F.countDistinct(F.col("event_id") % 4).alias("attribute_count"),
                F.max(F.col("ts").cast("timestamp")).alias("ingested_at")))
    return agg.select(
        "group_id", "obs_date", "row_count", "instrument_count", "attribute_count",
        F.when(F.col("row_count") > 1, "ok").otherwise("empty").alias("status"),
        F.concat(F.lit("raw/"), F.col("group_id"), F.lit("/obs__"), F.col("group_id"), F.lit("__"),
                 F.date_format("obs_date", "yyyyMMdd"), F.lit(f"__{RUN_TS}.parquet")).alias("volume_path"),
        "ingested_at")


V2_SQL = f"""v2 AS (
  SELECT group_id, obs_date, row_count, instrument_count, attribute_count,
         CASE WHEN row_count > 1 THEN 'ok' ELSE 'empty' END AS status,
         'raw/' || group_id || '/obs__' || group_id || '__' || strftime(obs_date, '%Y%m%d')
           || '__{RUN_TS}.parquet' AS volume_path,
         ingested_at
  FROM (SELECT 'U' || CAST(user_id AS VARCHAR) AS group_id, CAST(ts AS DATE) AS obs_date,
               COUNT(*) AS row_count, COUNT(DISTINCT event_type) AS instrument_count,
               COUNT(DISTINCT event_id % 4) AS attribute_count, MAX(ts) AS ingested_at
        FROM events GROUP BY 1, 2))"""


# ---------------------------------------------------------------------------------------------
# V3 instrument catalog
# ---------------------------------------------------------------------------------------------

def catalog_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw catalog as a search returns it: ``instrument_id, name`` (pipe-delimited)."""
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size")
    k = (F.col("p_partkey") % CATALOG_MOD).cast("int")
    series = F.when(k < len(ALL_CURATED),
                    F.element_at(F.array(*[F.lit(s) for s in ALL_CURATED]), k + 1)
                    ).otherwise(F.concat(F.lit("CPI - "), F.col("p_name")))
    # every tenth slot exists only in the Tokyo dataset, so Japan-only tiers miss some series
    ds_idx = F.when(k % 10 == 0, F.lit(1)).otherwise(F.col("p_size") % 3)
    dataset = F.element_at(F.array(*[F.lit(s) for s in DATASETS]), (ds_idx + 1).cast("int"))
    adj = F.when(F.col("p_partkey") % 5 == 0, "SA").otherwise("NSA")
    unit = F.when(F.col("p_partkey") % 2 == 0, "Index").otherwise("Percentage")
    name = F.concat_ws(" | ", F.lit("JP"), F.lit("ECON"), series, F.lit("M"), dataset,
                       F.lit("Monthly"), adj, unit)
    return part.select(F.concat(F.lit("I"), F.col("p_partkey").cast("string")).alias("instrument_id"),
                       name.alias("name"))


V3_SQL = f"""v3 AS (
  SELECT 'I' || CAST(p_partkey AS VARCHAR) AS instrument_id,
         concat_ws(' | ', 'JP', 'ECON',
           CASE WHEN p_partkey % {CATALOG_MOD} < {len(ALL_CURATED)}
                THEN {_sql_list(ALL_CURATED)}[p_partkey % {CATALOG_MOD} + 1]
                ELSE 'CPI - ' || p_name END,
           'M', {_sql_list(DATASETS)}[CASE WHEN p_partkey % {CATALOG_MOD} % 10 = 0 THEN 1 ELSE p_size % 3 END + 1], 'Monthly',
           CASE WHEN p_partkey % 5 = 0 THEN 'SA' ELSE 'NSA' END,
           CASE WHEN p_partkey % 2 = 0 THEN 'Index' ELSE 'Percentage' END) AS name
  FROM part)"""

# DuckDB form of P7 (segment k of the name, stripped, '' when absent).
def seg_sql(col: str, k: int) -> str:
    return f"coalesce(trim(string_split({col}, '|')[{k + 1}], ' ' || chr(9) || chr(10) || chr(13) || chr(11) || chr(12)), '')"


V3C_SQL = f"""v3c AS (
  SELECT instrument_id, name, {seg_sql('name', 2)} AS series, {seg_sql('name', 4)} AS dataset,
         {seg_sql('name', 5)} AS frequency, {seg_sql('name', 6)} AS adjustment,
         {seg_sql('name', 7)} AS unit
  FROM v3)"""


# ---------------------------------------------------------------------------------------------
# V4 attempts
# ---------------------------------------------------------------------------------------------

def attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_table(spark, sf_dir, "events").select("event_id", "ts", "user_id")
    msg = F.element_at(F.array(*[F.lit(m) for m in MESSAGES]), (F.col("event_id") % 12 + 1).cast("int"))
    return ev.select(
        F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("group_id"),
        F.date_format(F.to_date("ts"), "yyyyMMdd").alias("obs_date"),
        F.coalesce(msg.startswith("rows="), F.lit(False)).alias("ok"),
        msg.alias("message"),
        (F.col("event_id") % 3 + 1).cast("int").alias("pass"),
        F.col("event_id").alias("attempt_id"),
        F.col("ts").cast("timestamp").alias("attempted_at"))


V4_SQL = f"""v4 AS (
  SELECT 'U' || CAST(user_id AS VARCHAR) AS group_id,
         strftime(CAST(ts AS DATE), '%Y%m%d') AS obs_date,
         coalesce(starts_with({_sql_list(MESSAGES)}[event_id % 12 + 1], 'rows='), false) AS ok,
         {_sql_list(MESSAGES)}[event_id % 12 + 1] AS message,
         CAST(event_id % 3 + 1 AS INTEGER) AS pass,
         event_id AS attempt_id, ts AS attempted_at
  FROM events)"""


# ---------------------------------------------------------------------------------------------
# V6 price observations
# ---------------------------------------------------------------------------------------------

def price_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber",
                                                      "l_extendedprice", "l_shipdate")
    return li.select(
        F.concat(F.lit("I"), F.col("l_partkey").cast("string")).alias("instrument_id"),
        F.date_format(F.to_date("l_shipdate"), "yyyy-MM-dd").alias("date"),
        F.when(F.col("l_linenumber") == 4, F.lit(None).cast("double"))
         .otherwise(F.col("l_extendedprice")).alias("value"),
        "l_orderkey", "l_linenumber", "l_partkey")


V6_SQL = """v6 AS (
  SELECT 'I' || CAST(l_partkey AS VARCHAR) AS instrument_id,
         strftime(CAST(l_shipdate AS DATE), '%Y-%m-%d') AS date,
         CASE WHEN l_linenumber = 4 THEN NULL ELSE l_extendedprice END AS value,
         l_orderkey, l_linenumber, l_partkey
  FROM lineitem)"""


VIEW_SQL = {"v1": V1_SQL, "v2": V2_SQL, "v3": V3_SQL, "v3c": V3C_SQL, "v4": V4_SQL, "v6": V6_SQL}
_DEPS = {"v3c": ["v3"]}


def with_views(*names: str) -> str:
    """``WITH`` clause defining the named views (dependencies first)."""
    order: list[str] = []
    for n in names:
        for d in _DEPS.get(n, []) + [n]:
            if d not in order:
                order.append(d)
    return "WITH " + ",\n".join(VIEW_SQL[n] for n in order) + "\n"


# ---------------------------------------------------------------------------------------------
# V5 / V7 response pages (JSON text, one page per line)
# ---------------------------------------------------------------------------------------------

PAGE_SIZE = 16   # instruments per response page: pages stay bounded, their number grows


def observation_pages(v1_helpers: DataFrame, *, request="full", page_size: int = PAGE_SIZE,
                      ingested_at: str = PAGE_INGESTED_AT) -> DataFrame:
    """Nest V1 (with helper columns) into response pages; returns ``value`` = JSON text.

    Shapes vary by row: points are objects keyed ``date``/``obs_date``/``time`` or pairs in
    compact or ISO form (event_id % 5); every series ends with a junk scalar point; attributes
    use ``attribute_id``/``attribute``/``name`` keys and DOVE_SCORE ships under ``series``;
    instruments carry a name, an id, or a blank name plus an id (user_id % 3). A page holds at
    most ``page_size`` instruments (``page_no = user_id div page_size``). ``request`` is a
    label or a Column (e.g. per-row chunk labels), so every request kind lands in one job.
    """
    req = request if isinstance(request, Column) else F.lit(request)
    iso = F.date_format("date", "yyyy-MM-dd")
    ymd = F.date_format("date", "yyyyMMdd")
    v = F.col("value")
    shape = F.col("event_id") % 5
    opts = {"ignoreNullFields": "false"}
    point = (F.when(shape == 0, F.to_json(F.struct(iso.alias("date"), v.alias("value")), opts))
             .when(shape == 1, F.to_json(F.struct(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("obs_date"),
                                                   v.alias("value")), opts))
             .when(shape == 2, F.to_json(F.array(ymd, v)))
             .when(shape == 3, F.to_json(F.struct(F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("time"),
                                                   v.alias("value")), opts))
             .otherwise(F.to_json(F.array(iso, v))))
    base = v1_helpers.select("group_id", ymd.alias("day"), req.alias("request"), "user_id", "instrument",
                             "attribute", "event_id", point.alias("pj"))
    series = (base.groupBy("group_id", "day", "request", "user_id", "instrument", "attribute")
              .agg(F.array_sort(F.collect_list(F.struct("event_id", "pj"))).alias("pts")))
    akey = (F.when(F.col("attribute") == "HAWK_SCORE", "attribute")
            .when(F.col("attribute") == "DOVE_SCORE", "name").otherwise("attribute_id"))
    skey = F.when(F.col("attribute") == "DOVE_SCORE", "series").otherwise("time_series")
    attr_json = F.format_string('{"%s":"%s","%s":[%s,7]}', akey, F.col("attribute"), skey,
                                F.array_join(F.transform("pts", lambda x: x["pj"]), ","))
    attrs = (series.select("group_id", "day", "request", "user_id", "instrument", "attribute", attr_json.alias("aj"))
             .groupBy("group_id", "day", "request", "user_id", "instrument")
             .agg(F.array_sort(F.collect_list(F.struct("attribute", "aj"))).alias("attrs")))
    kind = F.col("user_id") % 3
    names = (F.when(kind == 0, F.format_string('"instrument_id":"%s"', F.col("instrument")))
             .when(kind == 1, F.format_string('"instrument_name":"%s"', F.col("instrument")))
             .otherwise(F.format_string('"instrument_name":"  ","instrument_id":"%s"', F.col("instrument"))))
    inst_json = F.format_string('{%s,"attributes":[%s]}', names,
                                F.array_join(F.transform("attrs", lambda x: x["aj"]), ","))
    pages = (attrs.select("group_id", "day", "request", F.floor(F.col("user_id") / page_size).cast("int").alias("page_no"),
                          "instrument", inst_json.alias("ij"))
             .groupBy("group_id", "day", "request", "page_no")
             .agg(F.array_sort(F.collect_list(F.struct("instrument", "ij"))).alias("insts")))
    page_json = F.format_string(
        '{"group_id":"%s","obs_date":"%s","request":"%s","page_no":%d,"ingested_at":"%s","instruments":[%s]}',
        F.col("group_id"), F.col("day"), F.col("request"), F.col("page_no"), F.lit(ingested_at),
        F.array_join(F.transform("insts", lambda x: x["ij"]), ","))
    return pages.select(page_json.alias("value"))


def price_pages(v6: DataFrame, *, page_size: int = PAGE_SIZE,
                ingested_at: str = PAGE_INGESTED_AT) -> DataFrame:
    """Nest V6 into monthly price response pages of at most ``page_size`` instruments
    (``value`` = JSON text). Points alternate between
    ISO pairs, ``date`` objects and ``time`` objects (l_linenumber % 3).

    The points meet their page in one shuffle and are sorted there once: an instrument's points
    stand together, and its entry opens at the first of them. Texts are joined, not formatted
    (``format_string`` is slow at one call per point); NULL is written as ``null``."""
    def text(c: Column) -> Column:
        return F.coalesce(c.cast("string"), F.lit("null"))

    def join(*parts) -> Column:
        return F.concat(*[F.lit(x) if isinstance(x, str) else text(x) for x in parts])

    shape = F.col("l_linenumber") % 3
    date, val = F.col("date"), F.col("value")
    point = (F.when(shape == 0, join('["', date, '",', val, ']'))
             .when(shape == 1, join('{"date":"', date, '","value":', val, '}'))
             .otherwise(join('{"time":"', date, ' 00:00:00","value":', val, '}')))
    placed = v6.select("instrument_id", "l_partkey", F.substring("date", 1, 7).alias("month"), "date", "l_orderkey",
                       "l_linenumber", "value", F.floor(F.col("l_partkey") / page_size).cast("int").alias("page_no"))
    base = placed.repartition("month", "page_no").withColumn("pj", point)
    # a page is bounded: a month of points of at most page_size instruments
    pages = (base.groupBy("month", "page_no")
             .agg(F.sort_array(F.collect_list(F.struct("instrument_id", "l_partkey", "date", "l_orderkey",
                                                       "l_linenumber", "pj"))).alias("pts")))
    start, end = '{"instrument_id":"', ']}]}'
    opened = '","attributes":[{"attribute_id":"NO_ATTRIBUTE","time_series":['

    def piece(x: Column, i: Column) -> Column:
        last = F.get(F.col("pts"), i - 1)
        same = (last["l_partkey"].eqNullSafe(x["l_partkey"])
                & last["instrument_id"].eqNullSafe(x["instrument_id"]))
        return (F.when(i == 0, join(start, x["instrument_id"], opened, x["pj"]))
                .when(same, join(",", x["pj"]))
                .otherwise(join(end, ",", start, x["instrument_id"], opened, x["pj"])))

    page_json = join('{"group_id":"PRICES","obs_date":"', F.regexp_replace(F.col("month"), "-", ""),
                     '01","request":"full","page_no":', F.col("page_no"), f',"ingested_at":"{ingested_at}","instruments":[',
                     F.array_join(F.transform("pts", piece), ""), end, ']}')
    return pages.select(page_json.alias("value"))
