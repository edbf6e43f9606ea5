"""K4: manifest as an append-only Parquet table with a "current row per key" reader.

Plain Parquet has no DELETE/MERGE; appending and resolving the newest row per key on read is
idempotent (a re-run appends an identical or newer row) and survives a failed job (Spark's
commit protocol publishes a run's files all at once or not at all).

So that a plan does not fold all history each time, :func:`fold_manifest` writes a snapshot: the current
rows of all committed runs, and the names of those runs, below ``{manifest}-snapshots``. Readers take
the newest complete snapshot and only the runs that it does not name (whatever their stamps: a late
rerun of an old stamp is one of them). A fold that crashed has no names and is not seen.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tessera.operators.ledger import RUN, current
from tessera.schemas import MANIFEST_COLUMNS, MANIFEST_SCHEMA
from tessera.session import file_system, is_complete, write_once


def append_manifest(rows: DataFrame, path: str, run: str | None = None) -> None:
    """Append manifest rows (one job for the whole run, not one per pair). The ``rebalance``
    hint lets AQE pack a small run into few files without funnelling a big one into one task.

    With a run stamp the rows carry it and are written once per stamp, in a folder of their own."""
    if run is None:
        rows.select(*MANIFEST_COLUMNS).hint("rebalance").write.mode("append").parquet(path)
        return
    write_once(rows.sparkSession, f"{path.rstrip('/')}/{run}",
               lambda: rows.select(*MANIFEST_COLUMNS).withColumn(RUN, F.lit(run)).hint("rebalance"))


_SCHEMA = T.StructType([*MANIFEST_SCHEMA.fields, T.StructField(RUN, T.StringType())])
FOLD_AFTER = 20             # runs outside the snapshot after which a job folds again


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Every manifest row ever appended, with its run stamp (NULL for rows appended without one)."""
    return spark.read.schema(_SCHEMA).option("recursiveFileLookup", "true").parquet(path)


def _names(spark: SparkSession, path: str, folders: bool) -> list[str]:
    """Names of the folders (or files) right below a path; hidden ones left out."""
    fs, where = file_system(spark, path)
    if not fs.exists(where):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(where)
                  if s.isDirectory() == folders and not s.getPath().getName().startswith(("_", ".")))


def _snapshots(path: str) -> str:
    return f"{path.rstrip('/')}-snapshots"


def _newest(spark: SparkSession, path: str) -> tuple[str | None, set[str]]:
    """(folder of the newest complete snapshot, the runs in it)."""
    for name in reversed(_names(spark, _snapshots(path), True)):
        folder = f"{_snapshots(path)}/{name}"
        if is_complete(spark, f"{folder}/runs"):
            return folder, {r.run for r in spark.read.schema("run string").json(f"{folder}/runs").collect()}
    return None, set()


def _tail(spark: SparkSession, path: str, folded: set[str]) -> list[str]:
    return [n for n in _names(spark, path, True) if n not in folded and is_complete(spark, f"{path.rstrip('/')}/{n}")]


def _live(spark: SparkSession, path: str, snapshot: str | None, tail: list[str]) -> DataFrame:
    root = path.rstrip("/")
    folders = [f"{root}/{n}" for n in tail] + ([f"{snapshot}/rows"] if snapshot else [])
    if any(n.endswith(".parquet") for n in _names(spark, root, False)):
        folders.append(root)                    # rows appended without a run stamp: files right below
    if not folders:
        return spark.createDataFrame([], _SCHEMA)
    rows = spark.read.schema(_SCHEMA).parquet(folders[0])
    if len(folders) > 1:
        for f in folders[1:]:
            rows = rows.unionByName(spark.read.schema(_SCHEMA).parquet(f))
    return rows


def read_live_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Manifest rows that can still be current: the newest snapshot and the runs after it."""
    fs, where = file_system(spark, path)
    if not fs.exists(where):
        return read_manifest(spark, path)       # the reader's own error
    snapshot, folded = _newest(spark, path)
    return _live(spark, path, snapshot, _tail(spark, path, folded))


def read_current_manifest(spark: SparkSession, path: str) -> DataFrame:
    """The current manifest: one row per (group, day)."""
    return current(read_live_manifest(spark, path))


def fold_manifest(spark: SparkSession, path: str, min_runs: int = 1) -> str | None:
    """Write a new snapshot if at least ``min_runs`` committed runs are not in the newest; returns it.

    Reads the newest snapshot and those runs only. The run names are written last: they are the mark."""
    snapshot, folded = _newest(spark, path)
    tail = _tail(spark, path, folded)
    if len(tail) < max(1, min_runs):
        return None
    number = 1 + max([int(n.split("=")[1]) for n in _names(spark, _snapshots(path), True)], default=0)
    folder = f"{_snapshots(path)}/fold={number:09d}"
    rows = current(_live(spark, path, snapshot, tail), keep_run=True)
    rows.hint("rebalance", "group_id").write.mode("overwrite").parquet(f"{folder}/rows")
    names = spark.createDataFrame([(n,) for n in sorted(folded | set(tail))], "run string")
    names.coalesce(1).write.mode("overwrite").json(f"{folder}/runs")
    return folder
