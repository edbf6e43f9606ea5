"""A stored word index over the catalog's names, which answers keyword searches without scanning them.

``build_index`` writes three tables below a folder, each once: ``names`` (row, id, name: distinct), ``postings``
(word -> rows, partitioned by a hash bucket of the word) and ``words`` (the vocabulary with its
buckets). A word is a run of characters without white space, lower-cased. A keyword holds no white space,
so a name contains it exactly if one of its words does: the vocabulary is searched for words that contain
the keyword, and only the buckets of these are read.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tessera.operators.catalog import dedupe_by_id
from tessera.session import write_once

BUCKETS = 256               # folders of postings: the most bucket numbers that reach the driver


def build_index(spark: SparkSession, raw: DataFrame, path: str, id_col: str = "instrument_id",
                name_col: str = "name") -> str:
    """Write the index of ``raw`` (rows with a null name are found by no search and left out)."""
    root = path.rstrip("/")
    write_once(spark, f"{root}/names", lambda: raw.where(F.col(name_col).isNotNull()).select(
        F.col(id_col).alias("id"), F.col(name_col).alias("name")).distinct().withColumn("row", F.monotonically_increasing_id()))
    words = F.explode(F.array_distinct(F.split(F.lower("name"), r"[ \t\n\x0B\f\r]+")))
    write_once(spark, f"{root}/postings", lambda: spark.read.parquet(f"{root}/names").select("row", words.alias("word"))
               .withColumn("bucket", F.pmod(F.xxhash64("word"), F.lit(BUCKETS)).cast("int")).hint("rebalance", "bucket"),
               partition_by=["bucket"])
    write_once(spark, f"{root}/words", lambda: spark.read.schema("row long, word string, bucket int").parquet(
        f"{root}/postings").select("word", "bucket").distinct())
    return root


def search_index(spark: SparkSession, path: str, keyword_sets, id_col: str = "instrument_id",
                 name_col: str = "name") -> DataFrame:
    """The same rows as ``operators.catalog.search_union`` over the indexed table: one row per id that has a name
    with every keyword of one of the sets (the smallest such name). A set without keywords finds
    every name, no set at all finds none."""
    root = path.rstrip("/")
    names = spark.read.schema("id string, name string, row long").parquet(f"{root}/names")
    sets = [sorted({w.lower() for w in s.split()}) for s in keyword_sets]

    def out(found: DataFrame) -> DataFrame:
        return dedupe_by_id(found.select(F.col("id").alias(id_col), F.col("name").alias(name_col)), id_col)

    if not all(sets) or not sets:
        return out(names if sets else names.limit(0))
    asked = sorted({w for s in sets for w in s})
    wanted = F.explode(F.filter(F.array(*[F.lit(w) for w in asked]), lambda w: F.col("word").contains(w)))
    matched = spark.read.schema("word string, bucket int").parquet(f"{root}/words").select("word", "bucket", wanted.alias("keyword"))
    buckets = [r[0] for r in matched.select("bucket").distinct().collect()]         # at most BUCKETS numbers
    postings = spark.read.schema("row long, word string, bucket int").parquet(f"{root}/postings").where(
        F.col("bucket").isin(buckets) if buckets else F.lit(False))
    held = postings.join(matched, ["bucket", "word"]).groupBy("row").agg(F.collect_set("keyword").alias("held"))
    any_set = F.lit(False)
    for s in sets:
        any_set = any_set | (F.size(F.array_intersect("held", F.array(*[F.lit(w) for w in s]))) == len(s))
    return out(names.join(held.where(any_set).select("row"), "row", "left_semi"))
