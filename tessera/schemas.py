"""Schemas of the data model (response pages, observations, manifest, attempts, catalogs)."""
from __future__ import annotations

from pyspark.sql import types as T

# A response page. Points are heterogeneous ({date|obs_date|time, value} objects, [date, value]
# pairs, or junk), so they are kept as VARIANT and decoded by the flatten operators.
ATTRIBUTE_STRUCT = T.StructType([
    T.StructField("attribute_id", T.StringType()),
    T.StructField("attribute", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("time_series", T.ArrayType(T.VariantType())),
    T.StructField("series", T.ArrayType(T.VariantType())),
])
INSTRUMENT_STRUCT = T.StructType([
    T.StructField("instrument_name", T.StringType()),
    T.StructField("instrument_id", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("attributes", T.ArrayType(ATTRIBUTE_STRUCT)),
])
PAGE_SCHEMA = T.StructType([
    T.StructField("group_id", T.StringType()),
    T.StructField("obs_date", T.StringType()),        # work-item day, compact YYYYMMDD
    T.StructField("request", T.StringType()),         # 'full' or 'chunk:<n>'
    T.StructField("page_no", T.IntegerType()),        # 0 = first page, then following pages
    T.StructField("ingested_at", T.StringType()),
    T.StructField("instruments", T.ArrayType(INSTRUMENT_STRUCT)),
])

OBSERVATION_SCHEMA = T.StructType([
    T.StructField("group_id", T.StringType()),
    T.StructField("instrument", T.StringType()),
    T.StructField("attribute", T.StringType()),
    T.StructField("date", T.DateType()),
    T.StructField("value", T.StringType()),
    T.StructField("obs_date", T.DateType()),
    T.StructField("ingested_at", T.TimestampType()),
])
OBSERVATION_COLUMNS = [f.name for f in OBSERVATION_SCHEMA.fields]
BRONZE_PARTITIONS = ["group_id", "obs_date"]

MANIFEST_SCHEMA = T.StructType([
    T.StructField("group_id", T.StringType()),
    T.StructField("obs_date", T.DateType()),
    T.StructField("row_count", T.LongType()),
    T.StructField("instrument_count", T.LongType()),
    T.StructField("attribute_count", T.LongType()),
    T.StructField("status", T.StringType()),
    T.StructField("volume_path", T.StringType()),
    T.StructField("ingested_at", T.TimestampType()),
])
MANIFEST_COLUMNS = [f.name for f in MANIFEST_SCHEMA.fields]
MANIFEST_KEY = ["group_id", "obs_date"]

ATTEMPT_SCHEMA = T.StructType([
    T.StructField("group_id", T.StringType()),
    T.StructField("obs_date", T.StringType()),
    T.StructField("ok", T.BooleanType()),
    T.StructField("message", T.StringType()),
    T.StructField("row_count", T.LongType()),
    T.StructField("instrument_count", T.LongType()),
    T.StructField("attribute_count", T.LongType()),
    T.StructField("volume_path", T.StringType()),
    T.StructField("manifest_warning", T.StringType()),
    T.StructField("pass", T.IntegerType()),
])

INSTRUMENT_CATALOG_COLUMNS = ["instrument_id", "name", "series", "dataset", "frequency",
                              "adjustment", "unit"]
