"""Properties and expected values of the Column expressions (no second implementation of a rule)."""
import datetime as dt

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from tessera import functions as TF
from tessera.operators import catalog as C

SETTINGS = settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@SETTINGS
@given(st.lists(st.tuples(st.dates(dt.date(2019, 1, 1), dt.date(2026, 12, 31)),
                          st.integers(-10, 40)), min_size=1, max_size=20))
def test_business_days_are_the_weekdays_of_the_range(spark, ranges):
    rows = [(s, s + dt.timedelta(days=n)) for s, n in ranges]
    df = spark.createDataFrame(rows, "s date, e date")
    got = [r.d for r in df.select(TF.business_days(F.col("s"), F.col("e")).alias("d")).collect()]
    for (s, e), days in zip(rows, got):
        assert days == sorted(set(days))
        assert all(s <= d <= e and d.isoweekday() <= 5 for d in days)
        # as many as numpy's own calendar counts
        assert len(days) == max(0, int(np.busday_count(s, e + dt.timedelta(days=1))))


@pytest.mark.parametrize("text, want", [
    (None, None), ("", ""), ("20240229", "2024-02-29"), ("20240230", None), ("20241301", None),
    ("00000000", None), ("2024-01-02", "2024-01-02"), ("2024-01-02T03:04:05", "2024-01-02"),
    ("2024-1-2", "2024-1-2"), ("2024010", "2024010"), ("202401021", "202401021"),
    ("2024/01/02 x", "2024/01/02"), ("        ", "        "), ("2024010a", "2024010a"),
])
def test_norm_date_values(spark, text, want):
    assert spark.createDataFrame([(text,)], "t string").select(TF.norm_date("t")).first()[0] == want


@SETTINGS
@given(st.lists(st.dates(dt.date(1900, 1, 1), dt.date(2100, 12, 31)), min_size=1, max_size=30))
def test_norm_date_reads_every_rendering_of_a_day(spark, days):
    shapes = [(d.strftime("%Y%m%d").zfill(8), d.isoformat(), d.isoformat() + "T10:20:30Z") for d in days]
    df = spark.createDataFrame(shapes, "a string, b string, c string")
    got = df.select(*[TF.norm_date(c).alias(c) for c in "abc"], TF.norm_date(TF.norm_date("a")).alias("again")).collect()
    assert [tuple(r) for r in got] == [(d.isoformat(),) * 4 for d in days]


@pytest.mark.parametrize("message, want", [
    (None, ("unknown", "std_backoff", 30)), ("", ("unknown", "std_backoff", 30)),
    ("boom", ("unknown", "std_backoff", 30)),
    ("HTTP 429", ("rate_limit", "long_backoff", 180)), ("Rate Limit hit", ("rate_limit", "long_backoff", 180)),
    ("QUOTA exceeded 401", ("rate_limit", "long_backoff", 180)),
    ("403 Unauthorized", ("auth_error", "sleep_and_retry", 60)),
    ("token expired", ("auth_error", "sleep_and_retry", 60)),
    ("path/x20240103y failed", ("auth_error", "sleep_and_retry", 60)),     # holds 401: plain substrings
    ("path/20240103 401x", ("auth_error", "sleep_and_retry", 60)),
    ("No Content", ("empty_payload", "skip", 0)), ("0 rows returned", ("empty_payload", "skip", 0)),
    ("TimeoutError: 5 s", ("timeout", "long_backoff", 90)), ("SSL handshake", ("timeout", "long_backoff", 90)),
    ("connection reset by peer", ("timeout", "long_backoff", 90)),
    ("validation of field", ("validation_failed", "retry", 15)),
])
def test_classify_values(spark, message, want):
    got = spark.createDataFrame([(message,)], "m string").select(TF.classify_failure("m").alias("c")).first().c
    assert (got.category, got.strategy, got.wait_s) == want


SEG = st.text(alphabet="ab |\t-", max_size=6)


@SETTINGS
@given(st.lists(st.lists(SEG, min_size=1, max_size=9).map("|".join), min_size=1, max_size=20),
       st.lists(st.text(alphabet="ab -|", min_size=1, max_size=5), min_size=1, max_size=5))
def test_segments_and_series_match(spark, names, requests):
    cat = spark.createDataFrame([(f"I{i}", n) for i, n in enumerate(names)], "instrument_id string, name string")
    segs = cat.select("name", *[TF.pipe_segment("name", k).alias(f"s{k}") for k in (0, 2, 7)]).collect()
    for r in segs:
        parts = [p.strip() for p in r.name.split("|")]
        for k in (0, 2, 7):
            assert r[f"s{k}"] == (parts[k] if k < len(parts) else "")
    req = spark.createDataFrame([(s,) for s in requests], "series string")
    got = sorted({(r.requested, r.instrument_id) for r in C.select_series(C.decompose(cat), req, unit=None).collect()})
    brute = sorted({(s, f"I{i}") for s in requests for i, n in enumerate(names) if f"| {s} |" in n})
    assert got == brute
