import datetime as dt

from pyspark.sql import functions as F

from tessera.plans import ingest
from tessera.schemas import MANIFEST_SCHEMA

D = dt.date


def manifest(spark, rows):
    return spark.createDataFrame(
        [(g, d, 1, 1, 1, s, "p", dt.datetime(2024, 2, 1)) for g, d, s in rows], MANIFEST_SCHEMA)


def groups(spark, *gs):
    return spark.createDataFrame([(g,) for g in gs], "group_id string")


def test_backfill_plan_skips_ok_only(spark):
    m = manifest(spark, [("A", D(2024, 1, 2), "ok"), ("A", D(2024, 1, 3), "empty")])
    plan = ingest.backfill_plan(groups(spark, "A", "B"), m, "20240101", "20240105")
    got = sorted((r.group_id, r.ymd) for r in plan.collect())
    assert len(got) == 9 and ("A", "20240102") not in got and ("A", "20240103") in got
    plan2 = ingest.backfill_plan(groups(spark, "A"), m, "20240101", "20240105", skip_statuses=("ok", "empty"))
    assert plan2.count() == 3
    assert ingest.backfill_plan(groups(spark, "A"), m, "20240101", "20240105", force=True).count() == 5


def test_backfill_empty_manifest_and_all_done(spark):
    empty = manifest(spark, [])
    assert ingest.backfill_plan(groups(spark, "A"), empty, "20240101", "20240110").count() == 8
    done = manifest(spark, [("A", D(2024, 1, d), "ok") for d in (1, 2, 3, 4, 5)])
    assert ingest.backfill_plan(groups(spark, "A"), done, "20240101", "20240105").count() == 0


def test_incremental_plan(spark):
    m = manifest(spark, [("A", D(2024, 1, 10), "ok"), ("A", D(2024, 1, 3), "empty"),
                         ("B", D(2024, 1, 31), "ok")])
    g = groups(spark, "A", "B", "C")
    plan = ingest.incremental_plan(g, m, "20240131", "20240125")
    per = {r.group_id: r for r in ingest.range_digest(g, plan).collect()}
    assert (per["A"].n_days, per["A"].first_ymd, per["A"].last_ymd) == (15, "20240111", "20240131")
    assert (per["B"].n_days, per["B"].first_ymd) == (0, None)      # up to date
    assert (per["C"].n_days, per["C"].first_ymd) == (5, "20240125")  # default start
    assert ingest.total_pairs(plan).first()["total_pairs"] == 20
    # a gap below the watermark is not revisited by the incremental plan (backfill does it)
    assert plan.filter(F.col("ymd") == "20240103").count() == 0


def test_plan_has_no_cartesian_product(spark):
    plan = ingest.backfill_plan(groups(spark, "A"), manifest(spark, []), "20240101", "20240110")
    txt = plan._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in txt and "NestedLoopJoin" not in txt
