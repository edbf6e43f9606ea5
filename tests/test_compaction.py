"""Partial compaction: only spans of small loads are rewritten, and readers see each row once."""
import glob
import os

from pyspark.sql import functions as F

from tessera.queries import analogues as A
from tessera.queries.q_files import loaded_in_runs
from tessera.sinks import bronze as B


def local(path):
    return path.removeprefix("file:").replace("//", "/")


def files(folder):
    return {(f, os.path.getmtime(f)) for f in glob.glob(f"{local(folder)}/**/*.parquet", recursive=True)}


def test_spans_leave_large_old_loads_alone():
    sizes = [("0", 1000), ("1", 10), ("2", 9), ("3", 300), ("4", 5), ("5", 6), ("6", 1)]
    assert B.spans(sizes, fan=4) == [["0", "1", "2", "3"], ["4", "5"], ["6"]]
    assert B.spans(sizes, fan=3) == [["0"], ["1", "2", "3"], ["4", "5"], ["6"]]
    assert B.spans([], 4) == [] and B.spans([("0", 7)], 4) == [["0"]]
    assert B.spans([("0", 100), ("1", 10), ("2", 10)], fan=4) == [["0"], ["1", "2"]]
    assert B.spans([("0", 80), ("1", 10), ("2", 10)], fan=4) == [["0", "1", "2"]]


def test_each_row_is_rewritten_a_logarithmic_number_of_times():
    loads, written, n = [], 0, 256
    for k in range(n):
        loads.append((str(k), 1))
        for s in B.spans(loads, fan=1):
            if len(s) > 1:
                size = sum(b for name, b in loads if name in s)
                at = [name for name, _ in loads].index(s[0])
                loads = loads[:at] + [(s[0], size)] + loads[at + len(s):]
                written += size
    assert sum(b for _, b in loads) == n and written <= 9 * n and len(loads) <= 9


def test_small_loads_are_merged_and_the_large_one_keeps_its_files(spark, sf_dir):
    bronze = loaded_in_runs(spark, sf_dir)
    before = sorted(B.live_folders(spark, bronze))
    assert len(before) == 5
    rows = sorted(map(str, B.read_bronze(spark, bronze).collect()))
    assert B.compact_waste(spark, bronze, fan=1, waste=0.9) == []          # too little to gain
    assert B.compact_waste(spark, bronze, min_loads=6) == []
    assert sorted(B.live_folders(spark, bronze)) == before
    kept = files(before[0])
    made = B.compact_waste(spark, bronze, fan=1, waste=0.0)
    live = sorted(B.live_folders(spark, bronze))
    assert made and len(live) < 5 and before[0] in live and files(before[0]) == kept
    assert sorted(map(str, B.read_bronze(spark, bronze).collect())) == rows
    moved = spark.read.option("recursiveFileLookup", "true").parquet(*made).count()
    assert moved < len(rows) / 2                                             # rows written follow the waste
    assert B.compact_waste(spark, bronze, fan=10 ** 6, waste=0.0)            # all of it, the merged folder included
    assert len(B.live_folders(spark, bronze)) == 1
    assert sorted(map(str, B.read_bronze(spark, bronze).collect())) == rows


def test_an_uncommitted_compaction_changes_nothing(spark, sf_dir):
    bronze = loaded_in_runs(spark, sf_dir)
    n = B.read_bronze(spark, bronze).count()
    made = B.compact_waste(spark, bronze, fan=10 ** 6, waste=0.0)
    os.remove(f"{local(made[0])}/_SUCCESS")                                 # crashed before its commit
    assert len(B.live_folders(spark, bronze)) == 5 and B.read_bronze(spark, bronze).count() == n
    assert B.compact_waste(spark, bronze, fan=10 ** 6, waste=0.0) == made
    assert B.read_bronze(spark, bronze).count() == n == A.observations(spark, sf_dir).agg(F.count(F.lit(1))).first()[0]


def test_a_table_without_loads_is_left_alone(spark, sf_dir):
    from tessera.session import scratch_dir
    path = scratch_dir(spark, "plain")
    assert B.compact_waste(spark, path) == []
    B.write_bronze(A.observations(spark, sf_dir), path)
    assert B.compact_waste(spark, path) == []
