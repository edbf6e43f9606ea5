"""Cursor-following listings (S1, S2, T4): loops, a page that fails, a cap that stops the calls."""
from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators.flatten import flatten_pages
from tessera.registry import query
from tessera.session import read_table, scratch_dir
from tessera.sources.fetch import follow_pages, land_fetched, landed_misses, landed_pages

PER_PAGE = 4                # events on a page of the fixture vendor
CAP = 5


def listing_vendor(item: dict, cursor, pass_no: int):
    """One (event type, day): its events in pages of PER_PAGE, by number. The last page of an odd day points
    back to the second; the third page of every third day fails."""
    n, k = int(item["n_events"]), int(cursor or 0)
    if k >= CAP:
        raise AssertionError("a page beyond the cap was asked for")
    if k == 2 and n % 3 == 0:
        raise ConnectionError("connection reset by peer")
    here = min(PER_PAGE, n - PER_PAGE * k)
    last = PER_PAGE * (k + 1) >= n
    following = (1 if n % 2 and k else None) if last else k + 1
    series = [[item["ymd"], str(here)]]
    return {"instruments": [{"instrument_name": f"P{k}", "attributes": [
        {"attribute_id": "N", "time_series": series}]}]}, following


@query("s1_cursor_pages", f"""
WITH d AS (SELECT event_type AS group_id, strftime(CAST(ts AS DATE), '%Y%m%d') AS ymd, count(*) AS n FROM events GROUP BY ALL),
w AS (SELECT *, (n + {PER_PAGE - 1}) // {PER_PAGE} AS pages FROM d),
f AS (SELECT *, n % 3 = 0 AND pages > 2 AS failed, CASE WHEN n % 3 = 0 AND pages > 2 THEN 2 ELSE least(pages, {CAP}) END AS got FROM w)
SELECT group_id, ymd, CAST(got AS BIGINT) AS n_pages, CAST(least(n, {PER_PAGE} * got) AS BIGINT) AS n_events,
       CASE WHEN failed THEN 'ConnectionError: connection reset by peer'
            WHEN pages > {CAP} THEN 'page_cap: stopped after {CAP} pages' END AS message
FROM f""")
def cursor_pages_q(spark, sf_dir):
    """Every listing of (event type, day): pages landed, events on them, how it ended early."""
    plan = read_table(spark, sf_dir, "events").groupBy(
        F.col("event_type").alias("group_id"), F.date_format("ts", "yyyyMMdd").alias("ymd")).agg(
        F.count(F.lit(1)).alias("n_events"))
    path = land_fetched(spark, scratch_dir(spark, "listings"),
                        lambda: follow_pages(plan, listing_vendor, page_cap=CAP))
    rows = flatten_pages(landed_pages(spark, path))
    found = rows.groupBy("group_id", F.date_format("obs_date", "yyyyMMdd").alias("ymd")).agg(
        F.countDistinct("instrument").alias("n_pages"), F.sum(F.col("value").cast("long")).alias("n_events"))
    ended = landed_misses(spark, path).select("group_id", F.col("obs_date").alias("ymd"), "message")
    return found.join(ended, ["group_id", "ymd"], "left").select("group_id", "ymd", "n_pages", "n_events", "message")
