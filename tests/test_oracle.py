"""Every registered query against its DuckDB oracle on the smallest driver tables."""
import pytest

from tessera.registry import ORACLE, QUERIES, load_all
from tessera.testing import compare, duck

load_all()


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, sf_dir, con, name):
    df = QUERIES[name](spark, sf_dir)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for bad in ("NestedLoopJoin", "CartesianProduct", "BatchEvalPython", "ArrowEvalPython"):
        assert bad not in plan, f"{name} plans a {bad}"
    if name not in ORACLE:
        assert df.count() >= 0
        return
    status = compare(df, con, ORACLE[name])
    assert status.startswith("OK"), status


def test_no_python_udfs_in_plans(spark, sf_dir):
    for name in ["x2_backfill_plan", "p1_flatten_strict", "x9_all_tiers", "x5_retry_plan", "w2_latest_version"]:
        plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        assert "PythonUDF" not in plan and "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
