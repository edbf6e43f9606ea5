"""End-to-end runs with a fixture vendor: backfill with retries, then an incremental run."""
from pyspark.sql import functions as F

from tessera.plans import jobs
from tessera.session import scratch_dir
from tessera.sinks.bronze import read_bronze
from tessera.sinks.manifest import read_current_manifest


def vendor(group_id, ymd, pass_no, **request):
    assert request == {"calendar": "CAL_USBANK", "frequency": "FREQ_DAY",
                       "conversion": "CONV_LASTBUS_ABS", "nan_treatment": "NA_NOTHING"}
    if group_id == "B" and ymd == "20240103" and pass_no == 1:
        raise TimeoutError("request timed out")            # recovers on pass 2
    if group_id == "B" and ymd == "20240104":
        raise RuntimeError("HTTP 204 no content")           # legitimately empty: never retried
    if group_id == "A" and ymd == "20240105":
        raise PermissionError("403 forbidden")              # fails on every pass
    # a bare vendor page: the work-item fields are filled in by the fetch connector
    return [{"instruments": [{"instrument_name": "X", "attributes": [
        {"attribute_id": "S", "time_series": [[ymd, "1"], [ymd, "2"]]}]}]}]


def test_backfill_then_incremental(spark):
    root = scratch_dir(spark, "t-job")
    groups = spark.createDataFrame([("A",), ("B",)], "group_id string")
    waits = []
    s = jobs.run_backfill(spark, groups, "20240101", "20240105", vendor, root=root,
                          run_ts="20240201T000000", ingested_at="2024-02-01T00:00:00",
                          sleep=waits.append).first()
    assert (s.pairs, s.successes, s.misses_actionable, s.misses_empty) == (10, 8, 1, 1)
    assert waits == [90, 60]     # pass 2 waits for the timeout class, pass 3 for the auth class
    p = jobs.paths(root)
    assert read_bronze(spark, p["bronze"]).count() == 16
    m = read_current_manifest(spark, p["manifest"])
    assert m.filter("status = 'ok'").count() == 8
    # a second backfill only asks for what is not ok yet: A's 5th (still failing) and B's 4th
    # (recorded 'empty'; re-asked by default like the source, skippable with skip_statuses)
    s2 = jobs.run_backfill(spark, groups, "20240101", "20240105", vendor, root=root,
                           run_ts="20240202T000000", ingested_at="2024-02-02T00:00:00",
                           sleep=waits.append).first()
    assert (s2.pairs, s2.successes, s2.misses_actionable, s2.misses_empty) == (2, 0, 1, 1)
    assert read_bronze(spark, p["bronze"]).count() == 16
    # incremental from the watermark: A's is the 4th (the 5th keeps failing), B's the 5th;
    # the 6th and 7th are a weekend, so A asks for the 5th, 8th, 9th and B for the 8th, 9th
    s3 = jobs.run_incremental(spark, groups, "20240109", "20240101", vendor, root=root,
                              run_ts="20240203T000000", ingested_at="2024-02-03T00:00:00",
                              sleep=waits.append).first()
    assert read_bronze(spark, p["bronze"]).filter(F.col("obs_date") > "2024-01-05").count() == 8
    assert (s3.pairs, s3.successes, s3.misses_actionable, s3.misses_empty) == (5, 4, 1, 0)


def price_vendor(ids, start, end, pass_no, **request):
    """Fixture price vendor: monthly points for each id; chunks containing I13 fail."""
    assert request["frequency"] == "FREQ_MONTH" and len(ids) <= 20
    if "I13" in ids:
        raise ConnectionError("connection reset")
    return [{"instruments": [{"instrument_id": i, "attributes": [{"attribute_id": "NO_ATTRIBUTE", "time_series": [
        [f"{start[:4]}-{start[4:6]}-28", 100.0], ["2026-03-31", 101.0], ["2026-03-31", None]]}]} for i in ids]}]


def test_run_tiers(spark):
    from tessera.operators.catalog import decompose, select_series
    from tessera.plans import tiers as T
    from tessera.sources.fetch import instrument_chunks
    names = []
    for k in range(60):
        series = ["CPI - Food", "CPI - All items", "CPI - Energy", "CPI - Widgets"][k % 4]
        dataset = ["Consumer Price Index - Japan", "Consumer Price Index - Tokyo"][k % 2]
        names.append((f"I{k}", f"JP | ECON | {series} | M | {dataset} | Monthly | NSA | Index"))
    cat = decompose(spark.createDataFrame(names, "instrument_id string, name string"))
    root = scratch_dir(spark, "t-tiers")
    rows = jobs.run_tiers(spark, cat, price_vendor, end_ymd="20260331", root=root).collect()
    # expected: every selected (tier, id) except the ids that shared a chunk with I13
    req = T.tier_requests(spark, cat)
    sel = {(r.tier, r.instrument_id) for r in select_series(cat, req).collect()}
    chunks = [set(r.ids) for r in instrument_chunks(spark.createDataFrame(
        sorted({(i,) for _, i in sel}), "instrument_id string")).collect()]
    assert all(len(c) <= 20 for c in chunks)
    lost = next((c for c in chunks if "I13" in c), set())
    expected = {(t, i) for t, i in sel if i not in lost}
    assert {(r.tier, r.instrument_id) for r in rows} == expected and expected
    assert ("main_categories", "I2") not in sel            # Food is Japan-only in the main tier
    assert {r.date for r in rows} == {"2025-09-28", "2026-03-31"}
    assert all(r.value is not None for r in rows)


def test_running_a_stamp_again_changes_nothing(spark):
    """Every stage is write-once per stamp: same bronze, manifest, attempts and calls after a rerun."""
    root = scratch_dir(spark, "t-rerun")
    groups = spark.createDataFrame([("A",), ("B",)], "group_id string")

    def run(fetch, force=True):
        return jobs.run_backfill(spark, groups, "20240101", "20240105", fetch, root=root, force=force,
                                 run_ts="20240201T000000", ingested_at="2024-02-01T00:00:00", sleep=lambda s: None).first()

    def state():
        p = jobs.paths(root)
        return (sorted(map(str, read_bronze(spark, p["bronze"]).collect())),
                sorted(map(str, read_current_manifest(spark, p["manifest"]).collect())))

    first, before = run(vendor), state()
    # nothing is asked again: a vendor that would fail changes nothing
    again = run(lambda *a, **k: 1 / 0)
    assert again == first and state() == before and len(before[0]) == 16


def test_crash_before_the_manifest_is_finished_by_a_rerun(spark, monkeypatch):
    root = scratch_dir(spark, "t-crash")
    groups = spark.createDataFrame([("B",)], "group_id string")
    run = lambda: jobs.run_backfill(spark, groups, "20240101", "20240105", vendor, root=root, run_ts="20240201T000000",
                                    ingested_at="2024-02-01T00:00:00", sleep=lambda s: None)

    class Crash(BaseException):
        pass

    def crash(*a, **k):
        raise Crash()

    with monkeypatch.context() as m:
        m.setattr("tessera.plans.process.append_manifest", crash)
        try:
            run()
            raise AssertionError("did not crash")
        except Crash:
            pass
    s = run().first()
    p = jobs.paths(root)
    assert (s.pairs, s.successes, s.misses_empty, s.total_pairs, s.first_ymd, s.last_ymd) == (5, 4, 1, 5, "20240101", "20240105")
    assert read_bronze(spark, p["bronze"]).count() == 8
    assert read_current_manifest(spark, p["manifest"]).filter("status = 'ok'").count() == 4
    ranges = spark.read.json(f"{p['reports']}/run=20240201T000000/ranges").collect()
    assert [(r.group_id, r.n_days, r.first_ymd, r.last_ymd) for r in ranges] == [("B", 5, "20240101", "20240105")]


def test_stage_errors_are_records(spark, monkeypatch):
    from tessera.plans.process import process_pairs
    obs = spark.sql("SELECT 'A' AS group_id, 'X' AS instrument, 'S' AS attribute, DATE '2024-01-02' AS date, "
                    "'1' AS value, DATE '2024-01-02' AS obs_date, TIMESTAMP '2024-02-01 00:00:00' AS ingested_at")
    plan = obs.select("group_id", "obs_date")

    def broken(*a, **k):
        raise OSError("disk full")

    with monkeypatch.context() as m:
        m.setattr("tessera.plans.process.write_raw_days", broken)
        r = process_pairs(plan, obs, raw_root=scratch_dir(spark, "t-se"), manifest_path=None, download_ts="T",
                          ingested_at="2024-02-01T00:00:00").first()
    assert (r.ok, r.message) == (False, "volume_write_error: OSError: disk full")
    with monkeypatch.context() as m:
        m.setattr("tessera.plans.process.append_manifest", broken)
        r = process_pairs(plan, obs, raw_root=scratch_dir(spark, "t-se"), manifest_path="x", download_ts="T",
                          ingested_at="2024-02-01T00:00:00").first()
    assert r.ok and r.manifest_warning == "manifest_warning: OSError: disk full"


def listing(group_id):
    return [{"instruments": [{"instrument_name": "X", "attributes": [{"attribute_id": a} for a in ("S", "V", "S,V", "W")]}]}]


def chunk_vendor(group_id, ymd, pass_no, attributes=None, **request):
    """Full requests of B are empty; a chunk with W fails on the 3rd in pass 1; A has an impossible date on the 4th."""
    if attributes is None and group_id == "B":
        return []
    if attributes and "W" in attributes and ymd == "20240103" and pass_no == 1:
        raise TimeoutError("timed out")
    day = "20241399" if group_id == "A" and ymd == "20240104" else ymd
    return [{"instruments": [{"instrument_name": "X", "attributes": [
        {"attribute_id": a, "time_series": [[day, 1.0]]} for a in attributes or ["S"]]}]}]


def test_chunk_fallback_failed_chunk_and_rejects(spark):
    root = scratch_dir(spark, "t-chunks")
    groups = spark.createDataFrame([("A",), ("B",)], "group_id string")
    s = jobs.run_backfill(spark, groups, "20240101", "20240104", chunk_vendor, root=root, run_ts="R", chunk_size=2,
                          ingested_at="2024-02-01T00:00:00", sleep=lambda s: None, fetch_attributes=listing).first()
    assert (s.pairs, s.successes, s.misses_actionable) == (8, 7, 1)
    p = jobs.paths(root)
    got = read_bronze(spark, p["bronze"]).groupBy("group_id").count().collect()
    assert {r[0]: r[1] for r in got} == {"A": 3, "B": 12}       # B: three attributes a day, from two chunks
    log = spark.read.parquet(f"{p['attempts']}/run=R/pass=1").filter("not ok").collect()
    assert {(r.group_id, r.obs_date): r.message.split(":")[0] for r in log} == {
        ("B", "20240103"): "TimeoutError", ("A", "20240104"): "rejected_rows"}


def test_group_fetch(spark):
    days = spark.createDataFrame([("20240101",), ("20240102",)], "ymd string")
    rows = jobs.fetch_group(spark, "B", days, chunk_vendor, listing, path=scratch_dir(spark, "t-gf"), chunk_size=2, request={})
    assert sorted((r.attribute, r.date, r.value) for r in rows.collect()) == [
        (a, d, "1.0") for a in "SVW" for d in ("20240101", "20240102")]
    none = spark.createDataFrame([], "id string")
    assert jobs.fetch_group(spark, "B", days, chunk_vendor, listing, path=scratch_dir(spark, "t-gf"), request={},
                            search_ids=none).count() == 0


def test_tiers_rerun_gives_equal_rows(spark):
    from tessera.operators.catalog import decompose
    names = [(f"I{k}", f"JP | ECON | CPI - All items | M | Consumer Price Index - Japan | Monthly | NSA | Index") for k in range(5)]
    cat = decompose(spark.createDataFrame(names, "instrument_id string, name string"))
    root = scratch_dir(spark, "t-tiers2")
    rows = [sorted(map(str, jobs.run_tiers(spark, cat, price_vendor, end_ymd="20260331", root=root).collect())) for _ in range(2)]
    assert rows[0] == rows[1] and rows[0]


def flaky_vendor(group_id, ymd, pass_no, **request):
    """A short wait (validation, 15 s, right on pass 3), a long one (rate limit, 180 s, right on pass 2), one
    that never comes (auth, 60 s)."""
    if group_id == "A" and pass_no < 3:
        raise ValueError("validation failed")
    if group_id == "B" and pass_no < 2:
        raise RuntimeError("429 too many requests")
    if group_id == "C":
        raise PermissionError("403 forbidden")
    return [{"instruments": [{"instrument_name": "X", "attributes": [{"attribute_id": "S", "time_series": [[ymd, pass_no]]}]}]}]


def test_due_retries_wait_for_their_own_class(spark):
    groups = spark.createDataFrame([("A",), ("B",), ("C",), ("D",)], "group_id string")
    seen = {}
    for due in (False, True):
        root, waits = scratch_dir(spark, "t-due"), []

        def run(fetch, waits=waits, due=due, root=root):
            return jobs.run_backfill(spark, groups, "20240101", "20240102", fetch, root=root, run_ts="R", due_retries=due,
                                     ingested_at="2024-02-01T00:00:00", sleep=waits.append, load=True).first()

        s = run(flaky_vendor)
        assert (s.pairs, s.successes, s.misses_actionable, s.misses_empty) == (8, 6, 2, 0)
        p = jobs.paths(root)
        rows = sorted((r.group_id, str(r.obs_date), r.value) for r in read_bronze(spark, p["bronze"]).collect())
        log = spark.read.schema(jobs.ATTEMPT_LOG_SCHEMA).parquet(f"{p['attempts']}/run=R/*")
        seen[due] = (rows, log.count(), sum(waits))
        done = {r.group_id: r.t for r in log.filter("ok").groupBy("group_id").agg(F.max("at_s").alias("t")).collect()}
        assert waits == ([180, 60] if not due else [15, 15, 30, 60, 60])
        assert done == ({"A": 240, "B": 180, "D": 0} if not due else {"A": 30, "B": 180, "D": 0})
        state = sorted(map(str, read_current_manifest(spark, p["manifest"]).collect()))
        again = run(lambda *a, **k: 1 / 0)                    # the stamp again: same steps, no call
        assert again == s and sorted(map(str, read_current_manifest(spark, p["manifest"]).collect())) == state
        assert read_bronze(spark, p["bronze"]).count() == 6
    assert seen[True][0] == seen[False][0] and seen[True][1] == seen[False][1] and seen[True][2] < seen[False][2]
