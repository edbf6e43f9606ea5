"""Exactly-once load of committed raw runs into bronze with Structured Streaming.

The stream follows the commit rows of the raw area (:mod:`tessera.sinks.commits`): a run is taken when
it is committed, and only its own folder is listed, however much history there is. The checkpoint
records the rows taken; a micro-batch writes its own ``load=<batch>-<part>`` folders of bronze and
replaces them when it is replayed. So a run is loaded once however often the job runs, a run that
crashed half-way is not loaded at all, and its rerun is loaded once. ``availableNow`` processes
everything new and stops, which fits a scheduled run. Rebuilding bronze from raw is the same job with
a fresh checkpoint and target.

A batch reads all its runs with the bronze schema in one scan (missing columns are NULL, extra ones
ignored). Only if Spark cannot read a file that way - another type, a broken file - the batch is read
again run by run, and such a run by its files' own schemas, cast afterwards
(:func:`tessera.sinks.bronze.cast_projection`). Files are read to the end before they are taken, so one
with a sound footer and broken pages is found too; it is recorded under ``_bad_files`` and does not
stop the others. Every other error (a lost executor, a full disk) fails the batch, which is then
replayed by the next run of the job.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.schemas import BRONZE_PARTITIONS, OBSERVATION_SCHEMA
from tessera.session import file_system
from tessera.sinks.bronze import cast_projection
from tessera.sinks.commits import COMMIT_SCHEMA, commit_found, commit_root

# What Spark says when a file's types or bytes do not fit (conditions, and the readers' own words).
_FILE_ERRORS = ("FAILED_READ_FILE", "CANNOT_READ_FILE_FOOTER", "PARQUET_COLUMN_DATA_TYPE_MISMATCH",
                "CANNOT_MERGE_SCHEMAS", "UNABLE_TO_INFER_SCHEMA", "is not a Parquet file")


def _file_error(exc: Exception) -> bool:
    text = str(exc)
    return any(mark in text for mark in _FILE_ERRORS)


def _sound(spark: SparkSession, files: list[str]) -> tuple[list[list[str]], list[tuple[str, str]]]:
    """Files that can be read to the end, as groups with one schema, and those that cannot with the reason.
    A group that fails is halved, so few bad files cost few reads."""
    try:
        rows = cast_projection(spark.read.option("mergeSchema", "true").parquet(*files))
        rows.write.format("noop").mode("overwrite").save()
        return [files], []
    except Exception as exc:  # noqa: BLE001 - only what is wrong with the files is handled here
        if not _file_error(exc):
            raise
        if len(files) == 1:
            return [], [(files[0], f"{type(exc).__name__}: {str(exc).splitlines()[0][:300]}")]
    half = len(files) // 2
    good, bad = _sound(spark, files[:half])
    more, lost = _sound(spark, files[half:])
    return good + more, bad + lost


def _files(spark: SparkSession, folder: str) -> list[str]:
    """Data files below a run's folder."""
    fs, path = file_system(spark, folder)
    found, out = fs.listFiles(path, True), []
    while found.hasNext():
        name = found.next().getPath()
        if name.getName().endswith(".parquet") and not name.getName().startswith((".", "_")):
            out.append(name.toString())
    return sorted(out)


def load_new_files(spark: SparkSession, raw_root: str, bronze_path: str, checkpoint: str, *,
                   max_runs_per_trigger: int = 50, timeout_s: float | None = None, adopt: bool = True) -> dict:
    """Load every committed raw run not loaded before; returns the progress counters.

    ``availableNow`` honours ``max_runs_per_trigger``: a large backlog (a rebuild) is split into bounded
    micro-batches instead of one giant batch (a batch's run stamps, at most that many, reach the
    driver). With ``adopt`` complete runs without a commit row get theirs first.
    """
    if adopt:
        commit_found(spark, raw_root)
    counts = {"batches": 0, "runs": 0, "files": 0, "bad_files": 0}
    fs, log = file_system(spark, commit_root(raw_root))
    fs.mkdirs(log)
    raw, bronze = raw_root.rstrip("/"), bronze_path.rstrip("/")

    def write(rows: DataFrame, number: int, part: int) -> None:
        (rows.hint("rebalance", *BRONZE_PARTITIONS).write.mode("overwrite")
         .option("partitionOverwriteMode", "static").partitionBy(*BRONZE_PARTITIONS)
         .parquet(f"{bronze}/load={number:09d}-{part:04d}"))

    def typed(folders: list[str]) -> DataFrame:
        return spark.read.schema(OBSERVATION_SCHEMA).option("recursiveFileLookup", "true").parquet(*folders)

    def attempt(rows: DataFrame, number: int, part: int) -> bool:
        try:
            write(rows, number, part)
            return True
        except Exception as exc:  # noqa: BLE001 - drift or a broken file; anything else fails the batch
            if not _file_error(exc):
                raise
            return False

    def load(batch: DataFrame, number: int) -> None:
        runs = sorted(r.run for r in batch.collect())
        folders = [f"{raw}/run={r}" for r in runs]
        files = {f: _files(spark, f) for f in folders}
        folders = [f for f in folders if files[f]]
        counts["batches"] += 1
        counts["runs"] += len(runs)
        counts["files"] += sum(map(len, files.values()))
        # a batch that is replayed may take other parts than before: none of the first attempt stays
        here, root = file_system(spark, bronze)
        for s in (here.listStatus(root) if here.exists(root) else []):
            if s.getPath().getName().startswith(f"load={number:09d}-"):
                here.delete(s.getPath(), True)
        if not folders or attempt(typed(folders), number, 0):
            return
        bad = []
        for part, folder in enumerate(folders, 1):
            if attempt(typed([folder]), number, part):
                continue
            good, lost = _sound(spark, files[folder])
            bad += lost
            rows = None
            for group in good:
                own = cast_projection(spark.read.option("mergeSchema", "true").parquet(*group))
                rows = own if rows is None else rows.unionByName(own)
            if rows is not None:
                write(rows, number, part)
            else:
                _drop(spark, f"{bronze}/load={number:09d}-{part:04d}")
        _drop(spark, f"{bronze}/load={number:09d}-0000")
        if bad:
            (spark.createDataFrame(bad, "file string, message string").coalesce(1).write.mode("overwrite")
             .json(f"{bronze}/_bad_files/batch={number:09d}"))
        counts["bad_files"] += len(bad)

    q = (spark.readStream.schema(COMMIT_SCHEMA).option("maxFilesPerTrigger", max_runs_per_trigger)
         .json(commit_root(raw_root)).writeStream.foreachBatch(load)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    finished = q.awaitTermination(timeout_s) if timeout_s else q.awaitTermination()
    if finished is False:
        q.stop()
        raise TimeoutError(f"bronze load did not finish within {timeout_s}s")
    if q.exception() is not None:
        raise q.exception()
    return counts


def _drop(spark: SparkSession, folder: str) -> None:
    """Remove what a failed attempt left."""
    fs, path = file_system(spark, folder)
    fs.delete(path, True)
