from tessera.operators.flatten import flatten_pages
from tessera.plans import ingest
from tessera.schemas import MANIFEST_SCHEMA
from tessera.session import scratch_dir
from tessera.sources.fetch import fetch_pages, land_fetched, landed_misses, landed_pages


def fake_fetch(group_id, ymd, pass_no=1):
    """Fixture vendor: one page per pair, a failure for B on the 3rd, nothing for B on the 4th."""
    if group_id == "B" and ymd == "20240103":
        raise ConnectionError("connection reset by peer")
    if group_id == "B" and ymd == "20240104":
        raise RuntimeError("HTTP 204 No Content")
    return [{"group_id": group_id, "obs_date": ymd, "request": "full", "page_no": 0,
             "ingested_at": "2024-02-01T00:00:00",
             "instruments": [{"instrument_name": "X", "attributes": [
                 {"attribute_id": "S", "time_series": [[ymd, "1.5"]]}]}]}]


def test_fetch_land_and_flatten(spark):
    groups = spark.createDataFrame([("A",), ("B",)], "group_id string")
    plan = ingest.backfill_plan(groups, spark.createDataFrame([], MANIFEST_SCHEMA), "20240101", "20240105")
    path = land_fetched(spark, scratch_dir(spark, "t-fetch"), lambda: fetch_pages(plan, fake_fetch))
    rows = flatten_pages(landed_pages(spark, path))
    assert rows.count() == 8
    # a complete landing is not fetched again
    land_fetched(spark, path, lambda: fetch_pages(plan, lambda *a: 1 / 0))
    assert landed_pages(spark, path).count() == 8
    att = {(r.group_id, r.obs_date): r.message for r in landed_misses(spark, path).collect()}
    assert att == {("B", "20240103"): "ConnectionError: connection reset by peer",
                   ("B", "20240104"): "empty_payload: 0 rows returned"}


def test_instrument_chunks_cover_each_id_once(spark):
    from tessera.sources.fetch import instrument_chunks
    ids = spark.createDataFrame([(f"I{i}",) for i in range(1000)] + [("I7",)], "instrument_id string")
    chunks = [r.ids for r in instrument_chunks(ids, chunk_size=20).collect()]
    flat = [i for c in chunks for i in c]
    assert sorted(flat) == sorted(f"I{i}" for i in range(1000))   # each id exactly once
    assert max(len(c) for c in chunks) <= 20 and len(chunks) >= 50


def test_many_items_use_many_tasks_by_default(spark):
    """Tiny work items: the task count follows their number under default adaptive settings."""
    import datetime as dt
    days = [(dt.date(2020, 1, 1) + dt.timedelta(days=i)).strftime("%Y%m%d") for i in range(575)]
    plan = spark.createDataFrame([("A", d) for d in days], "group_id string, ymd string")
    fetched = fetch_pages(plan, lambda g, d, n: [{"instruments": []}])
    path = land_fetched(spark, scratch_dir(spark, "t-fetch-many"), lambda: fetched)
    assert landed_pages(spark, path).count() == 575
    assert fetched.rdd.getNumPartitions() == 23


def test_bad_page_text_is_a_failed_attempt_and_numbers_keep_their_text(spark):
    plan = spark.createDataFrame([("A", "20240102"), ("B", "20240102"), ("C", "20240102")], "group_id string, ymd string")

    def vendor(g, d, n):
        if g == "A":
            return ['{"instruments": [', {"instruments": []}]
        if g == "B":
            return [{"instruments": [{"instrument_name": "X", "attributes": [{"attribute_id": "S", "time_series": [
                [d, 1.0], [d, 1e-07], {"date": d, "value": 2.50}, {"date": d, "value": "1.0"}, [d, None]]}]}]}]
        return [{"instruments": "no list"}]

    path = land_fetched(spark, scratch_dir(spark, "t-fetch-bad"), lambda: fetch_pages(plan, vendor))
    miss = {r.group_id: r.message for r in landed_misses(spark, path).collect()}
    assert set(miss) == {"A", "C"} and miss["A"].startswith("JSONDecodeError")
    values = sorted((r.value or "") for r in flatten_pages(landed_pages(spark, path)).collect())
    assert values == ["", "1.0", "1.0", "1e-07", "2.5"]


def _listing(item, cursor, pass_no, **request):
    """Fixture listings: A loops, B fails on its third page, C has 201 pages, D is empty, E 204s, F's first call fails."""
    g, k = item["group_id"], int(cursor or 0)
    page = {"instruments": [{"instrument_name": f"{g}{k}", "attributes": [
        {"attribute_id": "S", "time_series": [[item["ymd"], item["mark"]]]}]}]}
    if g == "A":
        return page, str((k + 1) % 3)                      # 0, 1, 2, then back to the first
    if g == "B":
        if k == 2:
            raise ConnectionError("connection reset by peer")
        return page, k + 1
    if g == "C":
        assert k < 200, "page 201 was asked for"
        return page, k + 1 if k < 200 else None
    if g == "D":
        return None, None
    if g == "E":
        raise RuntimeError("HTTP 204 No Content")
    if g == "F":
        return "no json", None
    return page, "" if k == 1 else 1                        # G: two pages


def test_listings_are_followed_capped_and_keep_what_they_found(spark):
    from tessera.sources.fetch import follow_pages
    plan = spark.createDataFrame([(g, "20240102", "7") for g in "ABCDEFG"], "group_id string, ymd string, mark string")
    calls = spark.sparkContext.accumulator(0)

    def counted(*a, **k):
        calls.add(1)
        return _listing(*a, **k)

    path = land_fetched(spark, scratch_dir(spark, "t-follow"), lambda: follow_pages(plan, counted))
    # A asks for its first page once more (its cursor is new), C makes exactly 200 calls
    assert calls.value == 4 + 3 + 200 + 1 + 1 + 1 + 2
    pages = {r["group_id"]: r["count"] for r in landed_pages(spark, path).groupBy("group_id").count().collect()}
    assert pages == {"A": 4, "B": 2, "C": 200, "G": 2}
    ended = {r.group_id: (r.ok, r.message.split(":")[0]) for r in landed_misses(spark, path).collect()}
    assert ended == {"B": (False, "ConnectionError"), "C": (True, "page_cap"), "D": (False, "empty_payload"),
                     "E": (False, "empty_payload"), "F": (False, "JSONDecodeError")}
    rows = flatten_pages(landed_pages(spark, path)).filter("group_id = 'B'")
    assert sorted((r.instrument, r.value) for r in rows.collect()) == [("B0", "7"), ("B1", "7")]
