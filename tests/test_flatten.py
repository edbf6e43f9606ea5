"""FIXTURES.md §1: nested response pages -> strict, light and CPI rows."""
import datetime as dt
import json

from pyspark.sql import functions as F

from tessera.operators.flatten import discover_attributes, flatten_pages
from tessera.session import scratch_dir
from tessera.sources.pages import read_pages


def pages_df(spark, pages):
    path = scratch_dir(spark, "test-pages")
    spark.createDataFrame([(json.dumps(p),) for p in pages], "value string").coalesce(1).write.text(path)
    return read_pages(spark, path)


def page(instruments, obs_date="20240102"):
    return {"group_id": "G", "obs_date": obs_date, "request": "full", "page_no": 0,
            "ingested_at": "2024-01-02T10:00:00", "instruments": instruments}


def test_demo_row(spark):
    p = pages_df(spark, [page([{"instrument_name": "ECB", "attributes": [
        {"attribute_id": "SENTIMENT", "time_series": [{"date": "2024-01-02", "value": "0.45"}]}]}])])
    rows = flatten_pages(p).collect()
    assert len(rows) == 1
    r = rows[0]
    assert (r.group_id, r.instrument, r.attribute, r.date, r.value, r.obs_date) == (
        "G", "ECB", "SENTIMENT", dt.date(2024, 1, 2), "0.45", dt.date(2024, 1, 2))


def test_point_shapes_strict_and_light(spark):
    pts = [["20240103", "1.5"], {"obs_date": "2024-01-04T00:00:00", "value": None}, 7, [None, "3"], ["x"]]
    p = pages_df(spark, [page([{"instrument_name": "A", "attributes": [{"attribute_id": "S", "time_series": pts}]}])])
    strict = sorted((r.date, r.value) for r in flatten_pages(p).collect())
    assert strict == [(dt.date(2024, 1, 3), "1.5"), (dt.date(2024, 1, 4), None)]
    light = sorted((r.date, r.value) for r in flatten_pages(p, "light").collect())
    assert light == [("2024-01-04", None), ("20240103", "1.5"), ("None", "3")]


def test_empty_time_series_and_names(spark):
    insts = [
        {"instrument_name": "  ", "instrument_id": "I2",
         "attributes": [{"attribute_id": "S", "time_series": [], "series": [["2024-01-05", "9"]]}]},
        {"attributes": [{"series": [["2024-01-05", "1"]]}]},
    ]
    p = pages_df(spark, [page(insts)])
    strict = [(r.instrument, r.attribute) for r in flatten_pages(p).collect()]
    assert strict == [("UNKNOWN", "UNKNOWN")]          # empty time_series hides series
    light = sorted((r.instrument, r.attribute, r.value) for r in flatten_pages(p, "light").collect())
    assert light == [("  ", "S", "9"), ("UNKNOWN", "UNKNOWN", "1")]


def test_invalid_compact_date_is_rejected_not_fatal(spark):
    p = pages_df(spark, [page([{"instrument_name": "A", "attributes": [
        {"attribute_id": "S", "time_series": [["20241301", "1"], ["20240102", "2"]]}]}])])
    out = flatten_pages(p, keep_rejects=True).collect()
    assert sorted((r.rejected, r.value) for r in out) == [(False, "2"), (True, "1")]
    assert [r.value for r in flatten_pages(p).collect()] == ["2"]


def test_cpi_profile(spark):
    p = pages_df(spark, [page([{"instrument_id": "I1", "attributes": [{"attribute_id": "NO_ATTRIBUTE", "time_series": [
        ["2024-01-31", 101.5], {"time": "2024-02-29T00:00:00", "value": "102.0"}, {"date": "2024-03-29", "value": None}]}]}])])
    rows = sorted((r.date, r.instrument_id, r.value) for r in flatten_pages(p, "cpi").collect())
    assert rows == [("2024-01-31", "I1", 101.5), ("2024-02-29", "I1", 102.0)]


def test_discover_attributes_first_seen_and_composite(spark):
    insts = [{"instrument_name": "A", "attributes": [{"attribute_id": "B"}, {"attribute_id": "A,B"}, {"name": "C"}]},
             {"instrument_name": "B", "attributes": [{"attribute": "A"}, {"attribute_id": " "}, {"attribute_id": "B"}]}]
    p = pages_df(spark, [page(insts)])
    got = [(r.attribute, r.position) for r in discover_attributes(p).orderBy("position").collect()]
    assert got == [("B", 1), ("C", 2), ("A", 3)]


def test_page_cap(spark):
    pgs = [dict(page([{"instrument_name": "A", "attributes": [{"attribute_id": "S", "time_series": [["2024-01-02", str(i)]]}]}]),
                page_no=i) for i in range(5)]
    p = pages_df(spark, pgs)
    assert flatten_pages(p, page_cap=2).count() == 3
    assert flatten_pages(p).filter(F.col("value").isNotNull()).count() == 5


def test_null_partition_key_is_rejected(spark):
    pg = page([{"instrument_name": "A", "attributes": [{"attribute_id": "S", "time_series": [["", "1"], ["2024-01-02", "2"]]}]}])
    pg.pop("obs_date")
    out = sorted((r.rejected, r.value) for r in flatten_pages(pages_df(spark, [pg]), keep_rejects=True).collect())
    assert out == [(False, "2"), (True, "1")]


def test_only_chunk_pages_meet_the_join(spark):
    """Full pages stay whatever their pair; chunk pages only of unanswered pairs (null keys are never answered)."""
    from tessera.plans.extract import choose_pages, light_extract
    def one(value):
        return [{"instrument_name": "A", "attributes": [{"attribute_id": "S", "time_series": [["20240103", value]]}]}]
    made = [page(one("f1"), "20240101"), page([], "20240102"), page(one("f3"), "20240103")]
    for day, request, value in [("20240101", "chunk:0", "c1"), ("20240102", "chunk:0", "c2"), ("20240102", "chunk:1", "c3")]:
        made.append({**page(one(value), day), "request": request})
    made += [{**page(one("f4"), "20240104"), "request": None}, {**page(one("o"), "20240105"), "request": "other"}]
    p = pages_df(spark, made)
    chosen = choose_pages(p)
    assert chosen.columns == p.columns
    assert sorted(r.value for r in flatten_pages(chosen).collect()) == ["c2", "c3", "f1", "f3", "f4"]
    assert sorted(r.value for r in light_extract(p).collect()) == ["c1", "c2", "c3", "f3", "f4"]
    plan = chosen._jdf.queryExecution().optimizedPlan()
    assert plan.nodeName() == "Union"
    full, chunks = (plan.children().apply(i).toString() for i in (0, 1))
    assert "Join" not in full and "Aggregate" not in full and "Join" in chunks
