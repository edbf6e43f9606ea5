from tessera.functions.text import pipe_segment
from tessera.operators import catalog as C


def test_pipe_segments(spark):
    df = spark.createDataFrame(
        [("JP | ECON | CPI - Food | M | Consumer Price Index - Japan | Monthly | NSA | Index",), ("a | b",)], "name string")
    rows = df.select(pipe_segment("name", 2).alias("s"), pipe_segment("name", 7).alias("u")).collect()
    assert [(r.s, r.u) for r in rows] == [("CPI - Food", "Index"), ("", "")]


def test_inner_segment_match_equals_substring(spark):
    names = ["A | CPI - Food | Japan | Index", "CPI - Food | x | y | Index", "A | B | CPI - Food",
             "A |CPI - Food| B | Index", "A | CPI - Food, less | B | Index", "A | X | CPI - Food | Index",
             "A | P | Q | Z", "P | Q | Z"]
    cat = C.decompose(spark.createDataFrame([(f"I{i}", n) for i, n in enumerate(names)], "instrument_id string, name string"))
    reqs = ["CPI - Food", "P | Q", "B"]
    req = spark.createDataFrame([(s,) for s in reqs], "series string")
    got = sorted((r.requested, r.instrument_id) for r in C.select_series(cat, req, unit=None).collect())
    brute = sorted((s, f"I{i}") for s in reqs for i, n in enumerate(names) if f"| {s} |" in n)
    assert got == brute
    assert ("CPI - Food", "I0") in got and ("P | Q", "I6") in got


def test_select_series_plan_is_equi_join(spark):
    cat = C.decompose(spark.createDataFrame([("I1", "A | B | C | D | E | F | G | Index")], "instrument_id string, name string"))
    req = spark.createDataFrame([("C",)], "series string")
    plan = C.select_series(cat, req)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoopJoin" not in plan and "CartesianProduct" not in plan


def test_dedupe_and_missing(spark):
    raw = spark.createDataFrame([("I1", "b"), ("I1", "a"), ("I2", "c")], "instrument_id string, name string")
    assert sorted(tuple(r) for r in C.dedupe_by_id(raw).collect()) == [("I1", "a"), ("I2", "c")]
    req = spark.createDataFrame([("t", "x"), ("t", "y")], "tier string, series string")
    sel = spark.createDataFrame([("t", "x")], "tier string, series string")
    assert [r.series for r in C.missing_series(req, sel).collect()] == ["y"]


def test_attach_catalog_missing_is_blank(spark):
    obs = spark.createDataFrame([("2024-01-31", "I1", 1.0), ("2024-01-31", "I9", 2.0)], "date string, instrument_id string, value double")
    lk = spark.createDataFrame([("I1", "S", "D", "N")], "instrument_id string, series string, dataset string, name string")
    rows = {r.instrument_id: (r.series, r.dataset, r.instrument_name) for r in C.attach_catalog(obs, lk).collect()}
    assert rows == {"I1": ("S", "D", "N"), "I9": ("", "", "")}


def test_sorted_fetch_is_in_order(spark, sf_dir):
    from tessera.registry import QUERIES, load_all
    load_all()
    rows = QUERIES["t1_sorted_fetch"](spark, sf_dir).collect()
    keys = [(r.tier, r.series, r.dataset, r.date, r.instrument_id) for r in rows]
    assert keys == sorted(keys) and len(set(keys)) > 10
