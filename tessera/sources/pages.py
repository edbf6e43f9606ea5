"""Landed response pages.

The vendor client is out of scope (no HTTP here). A fetcher lands each response page as one
JSON line; Spark scans the landing folder with an explicit schema (no inference, column
pruning), and points stay VARIANT until the flatten step decodes them.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tessera.schemas import PAGE_SCHEMA


CORRUPT = "_corrupt_record"


def read_pages_and_corrupt(spark: SparkSession, path: str, schema=PAGE_SCHEMA) -> DataFrame:
    """JSON Lines pages below ``path`` (recursively), with the text of lines that are no
    page in ``_corrupt_record`` (NULL for good pages). Nothing is left out."""
    from pyspark.sql import types as T
    full = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    return (spark.read.schema(full)
            .option("recursiveFileLookup", "true")
            .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
            .json(path))


def corrupt_pages(spark: SparkSession, path: str) -> DataFrame:
    """The landed lines that are no page, with the file each lies in."""
    # all columns are parsed: a truncated line shows only when the nested part is read
    return (read_pages_and_corrupt(spark, path).select("*", F.col("_metadata.file_path").alias("file_path"))
            .filter(F.col(CORRUPT).isNotNull() | F.col("instruments").isNull() & F.col("group_id").isNull())
            .select("file_path", F.col(CORRUPT).alias("line")))


def read_pages(spark: SparkSession, path: str, schema=PAGE_SCHEMA, *, on_corrupt: str = "fail") -> DataFrame:
    """The pages below ``path``. A line that is no page (truncated, not JSON) fails the query
    that reads it, so an incomplete result is never taken for a complete one; with
    ``on_corrupt="drop"`` such lines are left out and :func:`corrupt_pages` lists them."""
    if on_corrupt not in ("fail", "drop"):
        raise ValueError("on_corrupt must be 'fail' or 'drop'")
    return (spark.read.schema(schema)
            .option("recursiveFileLookup", "true")
            .option("mode", "FAILFAST" if on_corrupt == "fail" else "DROPMALFORMED")
            .json(path))


def write_pages(page_json: DataFrame, path: str) -> str:
    """Land pages given as a one-column DataFrame of JSON text (``value``)."""
    page_json.write.mode("overwrite").text(path)
    return path
