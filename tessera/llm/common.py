"""Shared pieces of the training-data operators."""
from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tessera.session import read_table, scratch_dir


BATCH_ROWS = 2_000          # documents in one Arrow batch: bounds what a task holds


def _bounded_batches(spark: SparkSession) -> None:
    """Smaller Arrow batches than the default of 10,000 rows, which suits numbers, not documents."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key)) > BATCH_ROWS:
        spark.conf.set(key, BATCH_ROWS)


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Columns of one input table (read through Spark only: the path may be any Spark store)."""
    _bounded_batches(spark)
    return read_table(spark, sf_dir, name).select(*columns)


def written(df: DataFrame, name: str, group: int | None = None) -> DataFrame:
    """``df`` as a table in the cluster's shared folder, read back.

    This cuts the lineage in a way that survives lost executors, keeps costly work from being done
    twice and fixes values that depend on task order (such as ``spread``). The folder is scratch
    space below ``spark.checkpoint.dir`` and belongs to the session.

    ``group``: bytes of a row group, about, for rows of a megabyte or so. By default the writer looks at
    sizes only every 100 rows and holds a page of so many, several times over; and a reader opens a whole
    row group at once.
    """
    _bounded_batches(df.sparkSession)
    path = scratch_dir(df.sparkSession, name)
    bounds = {"parquet.block.size": group, "parquet.page.size.row.check.min": 1} if group else {}
    df.write.options(**bounds).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def rows(spark: SparkSession, values: list, schema: str) -> DataFrame:
    """A small plan-sized table from driver values, as a literal in the plan (no RDD, no file)."""
    _bounded_batches(spark)
    parsed = F.from_json(F.lit(json.dumps(values)), f"array<struct<{schema}>>")
    return spark.range(1).select(F.inline(parsed))


def ranked(df: DataFrame, keys: list[str], order: list[str], most: int, spread: str,
           out: str = "rank") -> DataFrame:
    """Rank of every row within its key, 0-based, without gathering a key in one task.

    A key's rows are dealt over ``ceil(sqrt(most))`` salts (``most``: the largest key's row count,
    known from a histogram). Ranks inside a (key, salt) group come from a window, the groups' first
    ranks from a running sum over their counts: both windows see about ``sqrt(most)`` rows a group.
    ``spread`` names a stored integer column that spreads equal rows; rows of a key are ranked by
    salt, then by ``order``. All columns stay; one called ``out`` is replaced. An empty table gives no rows.
    """
    from pyspark.sql import Window as W
    salts = max(1, int(most ** 0.5 + 0.999999))
    salt, inside, n, first = (fresh(df, c) for c in ("_salt", "_in", "_n", "_first"))
    salted = df.withColumn(salt, F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int"))
    group = [*keys, salt]
    joined = [fresh(df, f"_k{i}") for i in range(len(group))]
    within = salted.withColumn(inside, F.row_number().over(
        W.partitionBy(*group).orderBy(*order)).cast("long") - 1)
    firsts = salted.groupBy(*group).agg(F.count(F.lit(1)).alias(n)).select(
        *[F.col(c).alias(k) for c, k in zip(group, joined)],
        (F.coalesce(F.sum(n).over(W.partitionBy(*keys).orderBy(salt).rowsBetween(
            W.unboundedPreceding, -1)), F.lit(0))).alias(first))
    same = F.lit(True)
    for c, k in zip(group, joined):
        same = same & F.col(c).eqNullSafe(F.col(k))
    return (within.join(firsts, same)
            .withColumn(out, F.col(first) + F.col(inside))
            .drop(salt, inside, first, *joined))


def fresh(df: DataFrame, base: str) -> str:
    """A column name that no column of ``df`` has (upper and lower case count as equal)."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base


def text_or_empty(c) -> Column:
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))


def hash_limit(share: float) -> int:
    """The 64-bit hash value below which about ``share`` of all hashes lie."""
    return min(2 ** 63 - 1, -2 ** 63 + int(min(1.0, max(0.0, share)) * 2 ** 53) * 2 ** 11)
