"""Round trip: expected rows first, nested into pages of random shapes, flattened back."""
import datetime as dt
import json

from hypothesis import HealthCheck, given, settings, strategies as st

from tessera.operators.flatten import flatten_pages
from tessera.session import scratch_dir
from tessera.sources.pages import read_pages

NAME = st.sampled_from(["N1", "N2", "a b", "ECB"])
DAY = st.dates(dt.date(2000, 1, 1), dt.date(2030, 12, 31))
VALUE = st.sampled_from([None, "0.45", "text", "1e-07", ""])
ROWS = st.lists(st.tuples(NAME, NAME, DAY, VALUE, st.integers(0, 10 ** 6)), min_size=1, max_size=25)


def point(day, value, shape):
    """One of the shapes that carry a dated value."""
    text = [day.isoformat(), day.strftime("%Y%m%d"), day.isoformat() + "T01:02:03"][shape % 3]
    return [{"date": text, "value": value}, {"obs_date": text, "value": value}, {"time": text, "value": value},
            [text, value], [text, value, "more"]][shape // 3 % 5], text


def nested(rows):
    """One instrument entry per row, its names under any of the keys, with junk points around."""
    out = []
    for instrument, attribute, day, value, shape in rows:
        p, _ = point(day, value, shape)
        i_key = ["instrument_name", "instrument_id"][shape // 15 % 2]
        a_key = ["attribute_id", "attribute"][shape // 30 % 2]
        s_key = ["time_series", "series"][shape // 60 % 2]
        junk = [[], [7], [["alone"]], ["x", None]][shape // 120 % 4]
        out.append({i_key: instrument, "attributes": [{a_key: attribute, s_key: [*junk, p]}]})
    return out


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(ROWS, min_size=1, max_size=3))
def test_rows_survive_any_nesting(spark, pages):
    path = scratch_dir(spark, "t-prop-pages")
    docs = [{"group_id": "G", "obs_date": "20240102", "request": "full", "page_no": i,
             "ingested_at": "2024-01-02T00:00:00", "instruments": nested(rows)} for i, rows in enumerate(pages)]
    spark.createDataFrame([(json.dumps(d),) for d in docs], "value string").coalesce(1).write.text(path)
    df = read_pages(spark, path)
    rows = [r for p in pages for r in p]
    got = sorted(((r.instrument, r.attribute, r.date, r.value) for r in flatten_pages(df).collect()), key=repr)
    assert got == sorted(((i, a, d, v) for i, a, d, v, _ in rows), key=repr)
    light = sorted(((r.instrument, r.attribute, r.date, r.value) for r in flatten_pages(df, "light").collect()), key=repr)
    assert light == sorted(((i, a, point(d, v, s)[1][:10], v) for i, a, d, v, s in rows), key=repr)
