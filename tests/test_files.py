import datetime as dt

from pyspark.sql import functions as F

from tessera.queries import analogues as A
from tessera.session import scratch_dir
from tessera.sinks import bronze as B
from tessera.sinks.raw import write_raw_days
from tessera.streaming.load import load_new_files


def test_load_is_exactly_once_and_rebuild_matches(spark, sf_dir):
    v1 = A.observations(spark, sf_dir)
    n = v1.count()
    raw, bronze, ck = scratch_dir(spark, "t-raw"), scratch_dir(spark, "t-bronze"), scratch_dir(spark, "t-ck")
    write_raw_days(v1.filter(F.dayofmonth("obs_date") <= 10), raw, "20240201T000000")
    load_new_files(spark, raw, bronze, ck)
    first = B.read_bronze(spark, bronze).count()
    write_raw_days(v1.filter(F.dayofmonth("obs_date") > 10), raw, "20240202T000000")
    load_new_files(spark, raw, bronze, ck)
    stats = load_new_files(spark, raw, bronze, ck)       # nothing new
    assert stats["files"] == 0
    assert 0 < first < n and B.read_bronze(spark, bronze).count() == n
    rebuilt, ck2 = scratch_dir(spark, "t-rebuilt"), scratch_dir(spark, "t-ck2")
    load_new_files(spark, raw, rebuilt, ck2)
    a = B.read_bronze(spark, bronze).exceptAll(B.read_bronze(spark, rebuilt)).count()
    b = B.read_bronze(spark, rebuilt).exceptAll(B.read_bronze(spark, bronze)).count()
    assert a == b == 0


def test_raw_rewrite_same_run_is_idempotent(spark, sf_dir):
    v1 = A.observations(spark, sf_dir)
    raw = scratch_dir(spark, "t-raw2")
    write_raw_days(v1, raw, "20240201T000000")
    write_raw_days(v1, raw, "20240201T000000")
    from tessera.sinks.raw import read_raw
    assert read_raw(spark, raw).count() == v1.count()


def test_bronze_read_prunes_partitions(spark, sf_dir):
    path = scratch_dir(spark, "t-bronze2")
    B.write_bronze(A.observations(spark, sf_dir), path)
    df = B.read_bronze(spark, path, group_id="view", start=dt.date(2024, 1, 8), end="2024-01-19")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "group_id" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert df.count() > 0


def test_compaction_keeps_rows(spark, sf_dir):
    src, dst = scratch_dir(spark, "t-bronze-src"), scratch_dir(spark, "t-bronze-dst")
    v1 = A.observations(spark, sf_dir)
    B.write_bronze(v1.filter(F.col("attribute") == "SENTIMENT"), src)
    B.write_bronze(v1.filter(F.col("attribute") != "SENTIMENT"), src)
    B.compact_bronze(spark, src, dst)
    assert B.read_bronze(spark, dst).exceptAll(B.read_bronze(spark, src)).count() == 0
    assert B.read_bronze(spark, dst).count() == v1.count()


def test_load_tolerates_drift_and_records_bad_files(spark):
    """Text dates, a missing and an extra column, and a file that is no Parquet, through the real load."""
    raw, bronze, ck = scratch_dir(spark, "t-drift"), scratch_dir(spark, "t-drift-b"), scratch_dir(spark, "t-drift-c")
    row = "SELECT 'G' AS group_id, 'X' AS instrument, 'S' AS attribute, {date} AS date, '1' AS value, " \
          "{day} AS obs_date, TIMESTAMP '2024-02-01 00:00:00' AS ingested_at"
    good = spark.sql(row.format(date="DATE '2024-01-02'", day="DATE '2024-01-02'"))
    good.write.parquet(f"{raw}/run=A")
    spark.sql(row.format(date="'2024-01-03'", day="'2024-01-03'")).withColumn("note", F.lit("legacy")).write.parquet(f"{raw}/run=B")
    spark.sql(row.format(date="'n/a'", day="'2024-01-04'")).drop("ingested_at").write.parquet(f"{raw}/run=C")
    spark.sql(row.format(date="DATE '2024-01-05'", day="DATE '2024-01-05'")).write.mode("append").parquet(f"{raw}/run=C")
    import os
    with open(f"{raw.removeprefix('file:')}/run=C/broken.parquet", "w") as f:
        f.write("no parquet")
    counts = load_new_files(spark, raw, bronze, ck)
    assert counts["bad_files"] == 1
    got = sorted((str(r.date), str(r.obs_date), r.ingested_at is None) for r in B.read_bronze(spark, bronze).collect())
    assert got == [("2024-01-02", "2024-01-02", False), ("2024-01-03", "2024-01-03", False),
                   ("2024-01-05", "2024-01-05", False), ("None", "2024-01-04", True)]
    assert spark.read.json(f"{bronze}/_bad_files").first().file.endswith("broken.parquet")
    assert load_new_files(spark, raw, bronze, ck)["files"] == 0


def test_compaction_of_a_loaded_table_is_what_readers_see(spark):
    raw, bronze, ck = scratch_dir(spark, "t-cmp"), scratch_dir(spark, "t-cmp-b"), scratch_dir(spark, "t-cmp-c")
    rows = lambda n: spark.range(n, n + 50).selectExpr(
        "'G' AS group_id", "cast(id AS string) AS instrument", "'S' AS attribute", "DATE '2024-01-02' AS date",
        "'1' AS value", "DATE '2024-01-02' AS obs_date", "TIMESTAMP '2024-02-01 00:00:00' AS ingested_at")
    for k in range(3):
        write_raw_days(rows(50 * k), raw, f"R{k}")
        load_new_files(spark, raw, bronze, ck)
    before = B.read_bronze(spark, bronze)
    assert before.count() == 150 and len(before.inputFiles()) >= 3
    B.compact_bronze(spark, bronze)
    after = B.read_bronze(spark, bronze)
    assert len(after.inputFiles()) == 1 and after.exceptAll(before).count() == 0 and after.count() == 150
    write_raw_days(rows(150), raw, "R3")                    # later loads add to the compacted table
    load_new_files(spark, raw, bronze, ck)
    assert B.read_bronze(spark, bronze).count() == 200
    assert B.compact_bronze(spark, bronze) and B.read_bronze(spark, bronze).count() == 200
    assert B.compact_bronze(spark, bronze) is None


OBS = ("SELECT '{g}' AS group_id, cast(id AS string) AS instrument, 'S' AS attribute, DATE '2024-01-02' AS date, "
       "'1' AS value, DATE '2024-01-02' AS obs_date, TIMESTAMP '2024-02-01 00:00:00' AS ingested_at FROM range(10)")


def _local(path):
    return path.removeprefix("file://").removeprefix("file:")


def test_a_half_written_run_is_loaded_once_after_its_rerun(spark):
    """A run that crashed before its commit mark, another run's load, then the rerun."""
    import os
    raw, bronze, ck = scratch_dir(spark, "t-half"), scratch_dir(spark, "t-half-b"), scratch_dir(spark, "t-half-c")
    spark.sql(OBS.format(g="A")).write.parquet(f"{raw}/run=R1")
    os.remove(f"{_local(raw)}/run=R1/_SUCCESS")
    write_raw_days(spark.sql(OBS.format(g="B")), raw, "R2")
    assert load_new_files(spark, raw, bronze, ck)["runs"] == 1
    assert {r.group_id for r in B.read_bronze(spark, bronze).collect()} == {"B"}
    write_raw_days(spark.sql(OBS.format(g="A")), raw, "R1")         # the rerun replaces what the crash left
    load_new_files(spark, raw, bronze, ck)
    load_new_files(spark, raw, bronze, ck)
    assert B.read_bronze(spark, bronze).groupBy("group_id").count().collect().__len__() == 2
    assert B.read_bronze(spark, bronze).count() == 20


def test_a_complete_run_without_commit_row_is_adopted(spark):
    import os

    from tessera.sinks.commits import commit_root, committed_runs
    raw, bronze, ck = scratch_dir(spark, "t-adopt"), scratch_dir(spark, "t-adopt-b"), scratch_dir(spark, "t-adopt-c")
    write_raw_days(spark.sql(OBS.format(g="A")), raw, "R1")
    os.remove(f"{_local(commit_root(raw))}/run=R1.json")            # the crash between the mark and the row
    assert load_new_files(spark, raw, bronze, ck, adopt=False)["runs"] == 0
    assert load_new_files(spark, raw, bronze, ck)["runs"] == 1 and committed_runs(spark, raw) == {"R1"}
    assert B.read_bronze(spark, bronze).count() == 10


def test_broken_pages_beside_a_sound_footer_do_not_stop_the_load(spark):
    import glob
    import os
    raw, bronze, ck = scratch_dir(spark, "t-pages"), scratch_dir(spark, "t-pages-b"), scratch_dir(spark, "t-pages-c")
    write_raw_days(spark.sql(OBS.format(g="A")), raw, "R1")
    write_raw_days(spark.sql(OBS.format(g="B")).unionByName(spark.sql(OBS.format(g="C"))), raw, "R2")
    broken = glob.glob(f"{_local(raw)}/run=R2/group=B/day=*/*.parquet")[0]
    data = bytearray(open(broken, "rb").read())
    data[4:200] = b"\xff" * 196
    with open(broken, "wb") as f:
        f.write(data)
    crc = os.path.join(os.path.dirname(broken), f".{os.path.basename(broken)}.crc")
    if os.path.exists(crc):
        os.remove(crc)
    counts = load_new_files(spark, raw, bronze, ck)
    assert counts["bad_files"] == 1 and spark.read.json(f"{bronze}/_bad_files").first().file.endswith(os.path.basename(broken))
    assert sorted(r.group_id for r in B.read_bronze(spark, bronze).collect()) == ["A"] * 10 + ["C"] * 10
    write_raw_days(spark.sql(OBS.format(g="D")), raw, "R3")         # later loads go on
    load_new_files(spark, raw, bronze, ck)
    assert B.read_bronze(spark, bronze).count() == 30


def test_errors_that_are_not_the_files_fail_the_batch(spark, monkeypatch):
    import pytest

    from tessera.streaming import load
    raw, bronze, ck = scratch_dir(spark, "t-err"), scratch_dir(spark, "t-err-b"), scratch_dir(spark, "t-err-c")
    write_raw_days(spark.sql(OBS.format(g="A")), raw, "R1")
    with monkeypatch.context() as m:
        m.setattr(load, "_files", lambda *a: (_ for _ in ()).throw(OSError("No space left on device")))
        with pytest.raises(Exception, match="No space left"):
            load_new_files(spark, raw, bronze, ck)
    load_new_files(spark, raw, bronze, ck)                           # the batch is replayed
    assert B.read_bronze(spark, bronze).count() == 10
