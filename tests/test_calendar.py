"""Month ends by calendar, and values as of them, against a plain version."""
import datetime as dt
import random

from pyspark.sql import functions as F

from tessera.operators import ledger, resample

D = dt.date


def ends(spark, rows, start, end):
    df = spark.createDataFrame(rows, "calendar string, holiday date")
    return resample.month_ends(df, start, end)


def test_holidays_at_month_end(spark):
    rows = [("A", None), ("B", D(2024, 5, 31)), ("B", D(2024, 5, 30)), ("B", D(2024, 5, 31)), ("B", D(2024, 6, 1))]
    got = {(r.calendar, r.month): (r.no, r.after, r.month_end) for r in ends(spark, rows, "2024-05-17", "20240602").collect()}
    assert got == {("A", D(2024, 5, 1)): (1, None, D(2024, 5, 31)), ("A", D(2024, 6, 1)): (2, D(2024, 5, 31), D(2024, 6, 28)),
                   ("B", D(2024, 5, 1)): (1, None, D(2024, 5, 29)), ("B", D(2024, 6, 1)): (2, D(2024, 5, 29), D(2024, 6, 28))}


def test_a_month_without_business_day_has_no_row(spark):
    rows = [("A", D(2024, 2, d)) for d in range(1, 30)]
    got = [(r.no, r.after, r.month_end) for r in ends(spark, rows, "2024-01-01", "2024-03-01").orderBy("no").collect()]
    assert got == [(1, None, D(2024, 1, 31)), (2, D(2024, 1, 31), D(2024, 3, 29))]


def test_as_of_equals_plain_version(spark):
    rng = random.Random(4)
    hol = [("A", None)] + [("B", D(2023, 1, 1) + dt.timedelta(rng.randrange(500))) for _ in range(160)] \
        + [("B", D(2023, 8, d)) for d in range(1, 32)]
    table = ends(spark, hol, "2023-01-01", "2024-04-30")
    obs = []
    for k in range(40):
        for _ in range(rng.choice([1, 3, 40])):
            obs.append((k, "AB"[k % 2], D(2023, 1, 1) + dt.timedelta(rng.randrange(490)), rng.choice([None, float(len(obs))]), len(obs)))
    obs += [(50, "A", None, 1.0, 0), (51, "unknown", D(2023, 3, 3), 1.0, 0), (52, None, D(2023, 3, 3), 1.0, 0),
            (None, "A", D(2023, 3, 3), 7.0, 0)]
    df = spark.createDataFrame(obs, "id int, calendar string, date date, value double, seq int")
    got = {(r.id, r.month_end): (r.as_of, r.value) for r in
           resample.last_business_values(df, table, keys=["id"], tiebreak=["seq"]).collect()}
    stops = {}
    for r in table.collect():
        stops.setdefault(r.calendar, []).append(r.month_end)
    want = {}
    for key in {o[0] for o in obs}:
        mine = [o for o in obs if o[0] == key and o[2] is not None and o[1] in stops]
        days = sorted(stops[mine[0][1]]) if mine else []
        for i, e in enumerate(days):
            before = [o for o in mine if o[2] <= e]
            if before and (i == 0 or days[i - 1] < max(o[2] for o in mine)):
                best = max(before, key=lambda o: (o[2], o[4]))
                want[key, e] = (best[2], best[3])
    assert got == want and len(want) > 300


def test_empty_observations(spark):
    table = ends(spark, [("A", None)], "2024-01-01", "2024-02-01")
    df = spark.createDataFrame([], "id int, calendar string, date date, value double")
    assert resample.last_business_values(df, table, keys=["id"]).count() == 0


def test_merged_sketches_equal_one_pass(spark):
    obs = spark.range(60_000).select(
        (F.col("id") % 3).cast("string").alias("group_id"), F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 17).cast("int")).alias("obs_date"),
        (F.col("id") % 20_000).cast("string").alias("instrument"), F.when(F.col("id") % 2 == 0, "x").alias("attribute"))
    by_day = ledger.merged_counts(ledger.pair_sketches(obs))
    exact = {r.group_id: r.n for r in obs.groupBy("group_id").agg(F.countDistinct("instrument").alias("n")).collect()}
    for r in by_day.collect():
        assert r.row_count == 20_000 and r.attribute_estimate == 1
        assert abs(r.instrument_estimate - exact[r.group_id]) <= 0.08 * exact[r.group_id]
    part = ledger.merged_counts(ledger.pair_sketches(obs).where("obs_date < '2024-01-04'"))
    once = ledger.merged_counts(ledger.pair_sketches(obs.where("obs_date < '2024-01-04'"), keys=["group_id"]))
    assert sorted(r.instrument_estimate for r in part.collect()) == sorted(r.instrument_estimate for r in once.collect())
