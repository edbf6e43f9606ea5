"""The driver contract in __spark_entry__.py."""
import importlib.util
import os

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def load_entry():
    spec = importlib.util.spec_from_file_location("spark_entry", os.path.join(ROOT, "__spark_entry__.py"))
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    return mod


def test_entry_and_registry(spark):
    se = load_entry()
    df = se.entry(spark)
    assert df.columns == ["group_id", "obs_date", "ymd"]
    assert df.count() > 0
    q, o = se.queries(), se.oracle_sql()
    assert set(o) <= set(q) and len(q) >= 80
    assert all(callable(f) for f in q.values())
