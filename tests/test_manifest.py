"""Folded manifest: snapshot and tail equal the full fold, after reruns, late runs and crashes."""
import datetime as dt
import random

from tessera.operators.ledger import current
from tessera.schemas import MANIFEST_SCHEMA
from tessera.session import scratch_dir
from tessera.sinks.manifest import append_manifest, fold_manifest, read_current_manifest, read_live_manifest, read_manifest


def rows(spark, seed, n=40):
    rng = random.Random(seed)
    keys = {(rng.choice("ABC"), dt.date(2024, 1, rng.randint(1, 25))) for _ in range(n)}
    return spark.createDataFrame([(g, d, rng.randint(0, 9), 1, 1, rng.choice(["ok", "empty"]), f"p{seed}",
                                   dt.datetime(2024, 2, rng.randint(1, 3))) for g, d in sorted(keys)], MANIFEST_SCHEMA)


def table(df):
    return sorted(map(tuple, df.collect()))


def check(spark, path):
    assert table(read_current_manifest(spark, path)) == table(current(read_manifest(spark, path)))


def test_snapshot_and_tail_equal_the_full_fold(spark):
    path = scratch_dir(spark, "t-fold")
    for k in range(3):
        append_manifest(rows(spark, k), path, f"2024020{k + 4}T000000")
    first = fold_manifest(spark, path)
    assert first and fold_manifest(spark, path) is None
    check(spark, path)
    append_manifest(rows(spark, 7), path, "20240209T000000")
    append_manifest(rows(spark, 8), path, "20240101T000000")       # an older stamp that comes late
    append_manifest(rows(spark, 0), path, "20240204T000000")       # a rerun: nothing is written
    append_manifest(rows(spark, 9), path)                          # without a stamp
    check(spark, path)
    files = {f.split("/t-fold-")[1].split("/", 1)[1].split("/")[0] for f in read_live_manifest(spark, path).inputFiles()}
    assert not files & {"20240204T000000", "20240205T000000", "20240206T000000"}
    assert fold_manifest(spark, path, min_runs=3) is None
    second = fold_manifest(spark, path)
    assert second > first
    check(spark, path)


def test_a_crashed_fold_is_not_seen(spark, monkeypatch):
    import pytest
    path = scratch_dir(spark, "t-crash")
    append_manifest(rows(spark, 1), path, "R1")
    with monkeypatch.context() as m:
        m.setattr(type(spark), "createDataFrame", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError, match="lost"):
            fold_manifest(spark, path)                              # rows written, names not
    append_manifest(rows(spark, 2), path, "R2")
    check(spark, path)
    assert fold_manifest(spark, path).endswith("000000002")
    check(spark, path)


def test_a_run_that_is_not_committed_is_not_read(spark):
    import os
    path = scratch_dir(spark, "t-open")
    append_manifest(rows(spark, 1), path, "R1")
    rows(spark, 2).write.parquet(f"{path}/R2")
    os.remove(f"{path.removeprefix('file://').removeprefix('file:')}/R2/_SUCCESS")
    assert table(read_current_manifest(spark, path)) == table(current(rows(spark, 1)))
