"""Series selection and series fetch: which side of their joins Spark may broadcast or hash."""
import pytest

from tessera.operators import catalog as C
from tessera.registry import QUERIES, load_all
from tessera.session import scratch_dir


@pytest.fixture
def broadcasts(spark):
    """Spark's own default threshold: files of a few MB count as small."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(key)
    spark.conf.set(key, "10MB")
    yield
    spark.conf.set(key, old)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def stored_catalog(spark):
    names = ["A | CPI - Food | Japan | Index", "A | P | Q | Index", "CPI - Food | x | y | Index"]
    path = scratch_dir(spark, "test-catalog")
    C.decompose(spark.createDataFrame([(f"I{i}", n) for i, n in enumerate(names)],
                                      "instrument_id string, name string")).write.parquet(path)
    return spark.read.parquet(path)


def check_requests_are_sent(spark, sf_dir, name):
    load_all()
    plan = plan_of(QUERIES[name](spark, sf_dir))
    join = next(line for line in plan.splitlines() if "Join [_seg" in line)
    assert "BroadcastHashJoin" in join and "BuildRight" in join, plan


def test_p10_sends_the_requests_not_the_catalog(spark, sf_dir, broadcasts):
    check_requests_are_sent(spark, sf_dir, "p10_multi_literal")


@pytest.mark.parametrize("few", [True, False])
def test_select_series_never_builds_on_the_catalog(spark, broadcasts, few):
    req = spark.createDataFrame([("CPI - Food",), ("P | Q",)], "series string")
    sel = C.select_series(stored_catalog(spark), req, unit=None, few=few)
    assert "BuildLeft" not in plan_of(sel)
    assert sorted((r.requested, r.instrument_id) for r in sel.collect()) == [("CPI - Food", "I0"), ("P | Q", "I1")]


def test_j2_sends_the_requests_not_the_catalog(spark, sf_dir, broadcasts):
    check_requests_are_sent(spark, sf_dir, "j2_missing_series")


def test_t3_sends_the_requests_not_the_catalog(spark, sf_dir, broadcasts):
    check_requests_are_sent(spark, sf_dir, "t3_first_missing")


@pytest.mark.parametrize("name", ["x8_series_fetch", "x9_all_tiers"])
def test_fetch_broadcasts_no_price_rows(spark, sf_dir, broadcasts, name):
    load_all()
    plan = plan_of(QUERIES[name](spark, sf_dir))
    join = next(line for line in plan.splitlines() if "Join [instrument_id" in line)
    assert "ShuffledHashJoin" in join and "BuildRight" in join and "BuildLeft" not in plan, plan
