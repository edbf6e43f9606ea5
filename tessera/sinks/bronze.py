"""K3: the bronze table — Parquet partitioned by (group_id, obs_date).

Partition columns stay typed and unwrapped, so filters on them become ``PartitionFilters`` and
whole folders are skipped. The streaming load writes one ``load=<batch>`` folder per micro-batch;
compaction writes ``load=<first>..<last>``, one folder that stands for the loads it was made from.
Readers take a folder only if it is committed, and leave out loads that a committed compaction
covers: a compaction becomes visible, and its inputs invisible, in one step.

:func:`compact_waste` merges neighbouring loads only where that saves enough files, and leaves a load
alone that is much larger than all that came after it, so a row is rewritten a logarithmic number of
times however many loads follow.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tessera.schemas import BRONZE_PARTITIONS, OBSERVATION_COLUMNS, OBSERVATION_SCHEMA
from tessera.session import is_complete


def cast_projection(df: DataFrame) -> DataFrame:
    """The seven bronze columns with explicit lenient casts; absent columns become NULL.

    Bounds schema drift in raw files (extra columns are dropped, wrong types become NULL rather
    than failing the load under ANSI mode).
    """
    cols = []
    for f in OBSERVATION_SCHEMA.fields:
        if f.name in df.columns:
            cols.append(F.col(f.name).try_cast(f.dataType).alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    return df.select(*cols)


def write_bronze(obs: DataFrame, path: str, mode: str = "append") -> None:
    """Batch write in bronze layout."""
    (cast_projection(obs).hint("rebalance", *BRONZE_PARTITIONS)
     .write.mode(mode).partitionBy(*BRONZE_PARTITIONS).parquet(path))


def live_folders(spark: SparkSession, path: str) -> list[str] | None:
    """Folders of a loaded bronze table that readers take; None for a table without load folders
    (one written by :func:`write_bronze`). Their number is that of the micro-batches."""
    sc = spark.sparkContext
    root = sc._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(sc._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return None
    names = sorted(n for n in (s.getPath().getName() for s in fs.listStatus(root)) if n.startswith("load="))
    if not names:
        return None
    done = [n for n in names if is_complete(spark, f"{path.rstrip('/')}/{n}")]
    spans = [(n, *n.removeprefix("load=").split("..")) for n in done if ".." in n]
    out = []
    for n in done:
        first, last = (n.removeprefix("load=").split("..") * 2)[:2]
        covered = any(c != n and lo <= first and last <= hi for c, lo, hi in spans)
        if not covered:
            out.append(f"{path.rstrip('/')}/{n}")
    return out


def read_bronze(spark: SparkSession, path: str, *, group_id: str | None = None,
                start=None, end=None) -> DataFrame:
    """Bronze rows; ``group_id`` / ``start`` / ``end`` prune partitions."""
    reader = spark.read.schema(OBSERVATION_SCHEMA)
    folders = live_folders(spark, path)
    df = reader.parquet(path) if folders is None else reader.option("basePath", path).parquet(*folders)
    df = df.select(*OBSERVATION_COLUMNS)
    if group_id is not None:
        df = df.filter(F.col("group_id") == group_id)
    if start is not None:
        df = df.filter(F.col("obs_date") >= F.lit(start).cast("date"))
    if end is not None:
        df = df.filter(F.col("obs_date") <= F.lit(end).cast("date"))
    return df


def compact_bronze(spark: SparkSession, path: str, dst: str | None = None) -> str | None:
    """Rewrite a bronze table with about one file per partition.

    A loaded table is compacted in place: readers of ``path`` get the compacted folder as soon as it
    is committed, and later loads add to it. (The covered folders can be deleted once no reader that
    started before is left.) With ``dst`` the rows go to a new table there instead."""
    folders = live_folders(spark, path)
    if dst is not None or folders is None:
        write_bronze(read_bronze(spark, path), dst or path + "-compacted", mode="overwrite")
        return dst or path + "-compacted"
    if len(folders) < 2:
        return None
    bounds = [f.rsplit("load=", 1)[1].split("..") for f in folders]
    out = f"{path.rstrip('/')}/load={min(b[0] for b in bounds)}..{max(b[-1] for b in bounds)}"
    write_bronze(read_bronze(spark, path), out, mode="overwrite")
    return out


TARGET_BYTES = 128 << 20    # size of a file that needs no compaction
WASTE = 0.3                 # share of a span's files that compaction must save
FAN = 4                     # a load larger than FAN times all newer loads of its span stays as it is
COMPACT_AFTER = 20          # live load folders before a run compacts


def file_sizes(spark: SparkSession, folders: list[str]) -> DataFrame:
    """(load, partition, bytes), one row per data file: names and lengths only, no file is opened."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
            .option("pathGlobFilter", "*.parquet").load(folders)
            .select(F.regexp_extract("path", r"/load=([^/]+)/", 1).alias("load"),
                    F.regexp_extract("path", r"/load=[^/]+/(.*)/[^/]+$", 1).alias("partition"),
                    F.col("length").alias("bytes")))


def spans(sizes: list[tuple[str, int]], fan: int = FAN) -> list[list[str]]:
    """Spans of neighbouring loads of like size, oldest first. ``sizes``: (load, bytes) in load order, one entry
    per micro-batch. From the newest back, a load joins the span unless it is larger than ``fan`` times
    all newer loads there; then it starts the next span."""
    out, total = [], 0
    for load, size in reversed(sizes):
        if out and size <= fan * total:
            out[-1].append(load)
            total += size
        else:
            out.append([load])
            total = size
    return [s[::-1] for s in reversed(out)]


def compact_waste(spark: SparkSession, path: str, *, waste: float = WASTE, target: int = TARGET_BYTES,
                  fan: int = FAN, min_loads: int = 2) -> list[str]:
    """Merge spans of loads whose small files are worth it; returns the new folders.

    A span (see :func:`spans`) is rewritten if its partitions could do with ``1 - waste`` of its files,
    ``ceil(bytes / target)`` each; every other load keeps its files. Nothing is done below ``min_loads`` live
    folders. A crash leaves an uncommitted folder that no reader takes and the next call writes anew.
    """
    folders = live_folders(spark, path)
    if folders is None or len(folders) < max(2, min_loads):
        return []
    files = file_sizes(spark, folders)
    order = sorted((f.rsplit("load=", 1)[1] for f in folders), key=lambda n: n.split(".."))
    size = {r[0]: r[1] for r in files.groupBy("load").agg(F.sum("bytes")).collect()}     # one row per load
    wide = [s for s in spans([(n, size.get(n, 0)) for n in order], fan) if len(s) > 1]
    if not wide:
        return []
    span_of = F.create_map(*[F.lit(x) for i, s in enumerate(wide) for n in s for x in (n, i)])
    gain = (files.withColumn("span", span_of[F.col("load")]).where("span is not null")
            .groupBy("span", "partition").agg(F.count(F.lit(1)).alias("now"), F.sum("bytes").alias("bytes"))
            .groupBy("span").agg(F.sum("now").alias("now"), F.sum(F.greatest(
                F.lit(1), F.ceil(F.col("bytes") / target))).alias("then")))
    out = []
    for r in sorted(gain.where(F.col("now") - F.col("then") >= waste * F.col("now")).collect()):
        merged = wide[r.span]
        bounds = [n.split("..") for n in merged]
        to = f"{path.rstrip('/')}/load={bounds[0][0]}..{bounds[-1][-1]}"
        rows = (spark.read.schema(OBSERVATION_SCHEMA).option("basePath", path)
                .parquet(*[f"{path.rstrip('/')}/load={n}" for n in merged]))
        write_bronze(rows, to, mode="overwrite")
        out.append(to)
    return out
