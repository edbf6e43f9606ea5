"""Price pages: one shuffle to build them, one look at each point to read them, the same rows."""
import datetime as dt
import json

from pyspark.sql import functions as F

from tessera.operators.flatten import flatten_pages
from tessera.queries import analogues as A
from test_flatten import page, pages_df


def points(spark):
    day = dt.date(2024, 1, 31)
    rows = [(f"I{k}", k, d, o, n, v) for k in (3, 17, 4) for d in (day, dt.date(2024, 2, 1))
            for o, n, v in [(2, 1, 1.5), (1, 3, 2.0), (1, 2, None), (1, 2, None)]]
    rows += [(None, None, day, 1, 1, 3.0), ("I5", 5, None, 1, 1, 4.0), ("I5", 5, day, 1, None, 12345678.25)]
    return spark.createDataFrame(rows, "instrument_id string, l_partkey long, d date, l_orderkey long, l_linenumber int, "
                                       "value double").withColumn("date", F.date_format("d", "yyyy-MM-dd")).drop("d")


def expected(rows):
    def point(r):
        date, value = r.date or "null", "null" if r.value is None else str(r.value)
        value = "1.234567825E7" if r.value == 12345678.25 else value
        shape = None if r.l_linenumber is None else r.l_linenumber % 3
        return {0: f'["{date}",{value}]', 1: f'{{"date":"{date}","value":{value}}}'}.get(
            shape, f'{{"time":"{date} 00:00:00","value":{value}}}')

    made = {}
    low = lambda x: (x is not None, x if x is not None else 0)
    for r in sorted(rows, key=lambda r: (low(r.date), low(r.l_orderkey), low(r.l_linenumber))):
        key = (r.date and r.date[:7], None if r.l_partkey is None else r.l_partkey // 16)
        made.setdefault(key, {}).setdefault(r.instrument_id, []).append(point(r))
    out = []
    for (month, no), insts in made.items():
        body = ",".join(f'{{"instrument_id":"{i or "null"}","attributes":[{{"attribute_id":"NO_ATTRIBUTE","time_series":'
                        f'[{",".join(p)}]}}]}}' for i, p in sorted(insts.items(), key=lambda x: x[0] or ""))
        out.append(f'{{"group_id":"PRICES","obs_date":"{(month or "null").replace("-", "")}01","request":"full","page_no":'
                   f'{"null" if no is None else no},"ingested_at":"{A.PAGE_INGESTED_AT}","instruments":[{body}]}}')
    return sorted(out)


def test_price_pages_text(spark):
    pts = points(spark)
    got = sorted(r.value for r in A.price_pages(pts).collect())
    assert got == expected(pts.collect())
    assert all(json.loads(x)["instruments"] for x in got)


def test_price_pages_take_one_shuffle(spark):
    plan = A.price_pages(points(spark))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_cpi_point_shapes_and_one_decoding(spark):
    pts = [["2024-01-31", 1], ["2024-01-31"], [None, "2"], ["", 3, 9], [4, "x"], 7, None, "text", {}, [],
           {"date": "", "time": "2024-02-29T00:00:00", "value": "5"}, {"date": "2024-03-01", "value": None},
           {"value": 6}, {"date": "2024-03-02", "value": "y"}, {"date": "2024-03-03", "value": [8]}, ["2024-03-04", None]]
    p = pages_df(spark, [page([{"instrument_id": "I1", "attributes": [{"time_series": pts}]}])])
    rows = flatten_pages(p, "cpi")
    assert rows.columns == ["date", "instrument_id", "value"]
    assert sorted((r.date, r.value) for r in rows.collect()) == [
        ("", 3.0), ("2024-01-31", 1.0), ("2024-02-29", 5.0), ("None", 2.0), ("None", 6.0)]
    every = flatten_pages(p, "cpi", keep_rejects=True)
    assert every.columns == ["date", "instrument_id", "value", "rejected"]
    assert sorted((r.date, r.value) for r in every.collect() if r.rejected) == [
        ("2024-03-02", None), ("2024-03-03", None), ("4", None)]
    windowed = rows.filter((F.col("date") >= "2024-01-01") & (F.col("date") <= "2024-12-31"))
    plan = windowed._jdf.queryExecution().executedPlan().toString()
    assert "map<" not in plan.lower() and "MapType" not in plan
    assert not [line for line in plan.splitlines() if "Filter" in line and "try_variant_get" in line]
