"""Commit rows of the raw area: which runs are complete, as a log that a stream can follow.

A run's folder counts once its job has committed it (``_SUCCESS``) *and* its commit row is there: one
small file per run below ``{raw}-commits``, published by a rename. A run that crashed half-way has no
row, so nothing of it is loaded; its rerun replaces the folder and adds the row. A crash between the
two leaves a complete run without a row: :func:`commit_found` adds it.
"""
from __future__ import annotations

import json

from pyspark.sql import SparkSession

from tessera.session import file_system, is_complete

COMMIT_SCHEMA = "run string"


def commit_root(raw_root: str) -> str:
    return f"{raw_root.rstrip('/')}-commits"


def commit_run(spark: SparkSession, raw_root: str, run: str) -> None:
    """Add the commit row of a complete run (once); a run that wrote nothing has none."""
    if not is_complete(spark, f"{raw_root.rstrip('/')}/run={run}"):
        return
    fs, path = file_system(spark, f"{commit_root(raw_root)}/run={run}.json")
    if fs.exists(path):
        return
    _, hidden = file_system(spark, f"{commit_root(raw_root)}/.run={run}.json")
    out = fs.create(hidden, True)
    out.write(bytearray(json.dumps({"run": run}) + "\n", "utf-8"))
    out.close()
    fs.rename(hidden, path)


def committed_runs(spark: SparkSession, raw_root: str) -> set[str]:
    fs, path = file_system(spark, commit_root(raw_root))
    if not fs.exists(path):
        return set()
    names = [s.getPath().getName() for s in fs.listStatus(path)]
    return {n[len("run="):-len(".json")] for n in names if n.startswith("run=") and n.endswith(".json")}


def commit_found(spark: SparkSession, raw_root: str) -> list[str]:
    """Add the rows of complete runs that have none (other writers, a crash before the row). Lists the
    names of the runs, never their files."""
    fs, path = file_system(spark, raw_root)
    if not fs.exists(path):
        return []
    have = committed_runs(spark, raw_root)
    names = [s.getPath().getName() for s in fs.listStatus(path)]
    new = sorted(n[len("run="):] for n in names if n.startswith("run=") and n[len("run="):] not in have)
    for run in new:
        commit_run(spark, raw_root, run)
    return new
