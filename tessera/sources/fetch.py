"""S1 connector form: call a vendor fetch function for every work item, on the executors.

The vendor client itself is out of scope (no credentials or HTTP here). A caller injects
``fetch(group_id, ymd, pass_no, **request) -> iterable of pages`` (dicts or JSON text). Work items are
spread over an explicit number of tasks (from their count; adaptive execution does not merge a
numbered repartition), each task calls the function item by item and hands on every item's pages
before it asks for the next (``mapInPandas``), so a task holds one item at a time. An exception - of
the call or of a page that is no JSON object - becomes an attempt record (``ok = false`` with the
error text) and none of the item's pages land; a "no content" error is recorded as an empty payload.
Land the result once with :func:`land_fetched`; :func:`landed_pages` and :func:`landed_misses` read it.
"""
from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tessera.functions.classify import NO_CONTENT_MARKERS
from tessera.schemas import PAGE_SCHEMA
from tessera.session import write_once
from tessera.sources.pages import CORRUPT

FETCH_SCHEMA = ("group_id string, obs_date string, chunk_no int, page_no int, page string, ok boolean, "
                "message string")
ITEMS_PER_TASK = 25         # work items a task should get
MAX_TASKS = 20_000

# The request parameters the source passes to the vendor for daily group data.
DAILY_REQUEST = {"calendar": "CAL_USBANK", "frequency": "FREQ_DAY",
                 "conversion": "CONV_LASTBUS_ABS", "nan_treatment": "NA_NOTHING"}

def _no_content(text: str) -> bool:
    """F9 on an exception text inside the task (same markers as the Column form)."""
    s = text.lower()
    return any(k in s for k in NO_CONTENT_MARKERS) or ("field required" in s and "instruments" in s)


def _text(value):
    """Numbers as ``str`` renders them: the value text is kept as the vendor's client shows it."""
    return str(value) if isinstance(value, (int, float)) and not isinstance(value, bool) else value


def _point(p):
    if isinstance(p, dict) and "value" in p:
        return {**p, "value": _text(p["value"])}
    return [p[0], _text(p[1]), *p[2:]] if isinstance(p, list) and len(p) >= 2 else p


def _landable(page, **fields) -> str:
    """A page as JSON text: missing work-item fields filled in, numeric values as text."""
    doc = json.loads(page) if isinstance(page, str) else dict(page)
    for k, v in fields.items():
        if doc.get(k) is None and v is not None:
            doc[k] = v
    for instrument in doc.get("instruments") or []:
        for attribute in instrument.get("attributes") or []:
            for key in ("time_series", "series"):
                if attribute.get(key):
                    attribute[key] = [_point(p) for p in attribute[key]]
    return json.dumps(doc)


def _spread(items: DataFrame, tasks: int | None, *keys: str) -> DataFrame:
    """Work items over tasks of about ``ITEMS_PER_TASK`` (one count; the number is then fixed)."""
    return items.repartition(tasks or min(MAX_TASKS, max(1, -(-items.count() // ITEMS_PER_TASK))), *keys)


def fetch_pages(plan: DataFrame, fetch, *, pass_no: int = 1, tasks: int | None = None,
                ingested_at: str | None = None, request: dict | None = None) -> DataFrame:
    """Run ``fetch(group_id, ymd, pass_no, **request)`` for every (group_id, ymd) of ``plan``;
    one output row per page, or one attempt row (``page`` NULL) for a pair that failed or
    returned nothing. ``request`` carries the vendor parameters (calendar, frequency,
    conversion, nan treatment); pass ``DAILY_REQUEST`` for the source's defaults.

    A plan with ``chunk_no`` and ``attributes`` asks for those attributes only (the call gets
    ``attributes=[...]``) and its pages are tagged ``chunk:<n>``. Pages missing the work-item fields
    get them from the work item (``group_id``, ``obs_date``, ``page_no`` = position, ``request``,
    ``ingested_at`` when given), so a vendor page that only carries ``instruments`` lands complete."""
    import pandas as pd

    params = dict(request or {})
    names = [f.split()[0] for f in FETCH_SCHEMA.split(", ")]
    chunked = "chunk_no" in plan.columns

    def call(item):
        g, d = item.group_id, item.ymd
        n = int(item.chunk_no) if chunked else None
        more = {"attributes": [str(a) for a in item.attributes]} if chunked else {}
        try:
            pages = [_landable(p, group_id=g, obs_date=d, page_no=i, ingested_at=ingested_at,
                               request="full" if n is None else f"chunk:{n}")
                     for i, p in enumerate(fetch(g, d, pass_no, **params, **more) or [])]
        except Exception as exc:  # noqa: BLE001 — every failure becomes a record
            msg = f"{type(exc).__name__}: {exc}"
            return [(g, d, n, None, None, False, "empty_payload: 0 rows returned" if _no_content(msg) else msg)]
        return ([(g, d, n, i, p, True, None) for i, p in enumerate(pages)]
                or [(g, d, n, None, None, False, "empty_payload: 0 rows returned")])

    def run(batches):
        for pdf in batches:
            for item in pdf.itertuples(index=False):
                yield pd.DataFrame(call(item), columns=names).astype({"chunk_no": "Int32", "page_no": "Int32"})

    keys = ["group_id", "ymd", *(["chunk_no"] if chunked else [])]
    items = plan.select(*keys, *(["attributes"] if chunked else []))
    return _spread(items, tasks, *keys).mapInPandas(run, FETCH_SCHEMA)


PAGE_CAP = 200              # pages of one listing that are asked for by default


def follow_pages(plan: DataFrame, fetch_page, *, page_cap: int = PAGE_CAP, pass_no: int = 1, tasks: int | None = None,
                 ingested_at: str | None = None, request: dict | None = None) -> DataFrame:
    """Listings that come page by page: ``fetch_page(item, cursor, pass_no, **request) -> (page, next)``.

    For every row of ``plan`` (``group_id``, ``ymd`` and whatever else the call needs; ``item`` is that row
    as a dict) a task asks for the first page (cursor None), then follows ``next`` until there is none.
    A cursor is followed once (listings may point back), and after ``page_cap`` pages no further call
    is made. Pages are handed on one by one, so a task holds one page. What was found stays: a call that
    fails ends its listing with an attempt record (``ok = false``, ``page_no`` = the page that is
    missing), and one that the cap cut short with a record ``page_cap`` (``ok = true``). A listing without
    any page is an empty payload. Same columns as :func:`fetch_pages`; land with :func:`land_fetched`.
    """
    import pandas as pd

    params = dict(request or {})
    names = [f.split()[0] for f in FETCH_SCHEMA.split(", ")]

    def listing(item: dict):
        g, d = item["group_id"], item["ymd"]
        cursor, seen, n = None, set(), 0
        while n < page_cap:
            try:
                page, following = fetch_page(item, cursor, pass_no, **params)
                text = None if page is None else _landable(page, group_id=g, obs_date=d, page_no=n,
                                                           ingested_at=ingested_at, request="full")
            except Exception as exc:  # noqa: BLE001 - the listing ends here, with a record
                msg = f"{type(exc).__name__}: {exc}"
                yield g, d, None, n, None, False, "empty_payload: 0 rows returned" if n == 0 and _no_content(msg) else msg
                return
            if text is not None:
                yield g, d, None, n, text, True, None
                n += 1
            if following is None or following == "" or following in seen:
                break
            seen.add(following)
            cursor = following
        else:
            yield g, d, None, n, None, True, f"page_cap: stopped after {n} pages"
        if n == 0:
            yield g, d, None, None, None, False, "empty_payload: 0 rows returned"

    def run(batches):
        for pdf in batches:
            for item in pdf.to_dict("records"):
                for row in listing(item):
                    yield pd.DataFrame([row], columns=names).astype({"chunk_no": "Int32", "page_no": "Int32"})

    return _spread(plan, tasks, "group_id", "ymd").mapInPandas(run, FETCH_SCHEMA)


def land_fetched(spark: SparkSession, path: str, build) -> str:
    """Write the fetched rows of ``build()`` once below ``path``, partitioned by outcome (``kind``:
    page or miss). A folder that is complete is not fetched again."""
    def kinds():
        kind = F.when(F.col("page").isNotNull(), "page").otherwise("miss")
        return build().withColumn("kind", kind)
    return write_once(spark, path, kinds, partition_by=["kind"])


def _landed(spark: SparkSession, path: str, kind: str) -> DataFrame:
    return spark.read.schema(f"{FETCH_SCHEMA}, kind string").parquet(path).filter(F.col("kind") == kind)


def landed_pages(spark: SparkSession, path: str) -> DataFrame:
    """Landed pages, parsed, with the pair they were fetched for and ``corrupt`` (text that does not
    fit the page schema: part of the page could not be read)."""
    schema = T.StructType([*PAGE_SCHEMA.fields, T.StructField(CORRUPT, T.StringType())])
    parsed = F.from_json("page", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    own = ["group_id", "obs_date", "page_no"]
    return _landed(spark, path, "page").select(*own, parsed.alias("p")).select(
        *[F.col(f.name) if f.name in own else F.col(f"p.{f.name}").alias(f.name) for f in PAGE_SCHEMA.fields],
        (F.col("p").isNull() | F.col(f"p.{CORRUPT}").isNotNull()).alias("corrupt"))


def landed_misses(spark: SparkSession, path: str) -> DataFrame:
    """(group_id, obs_date, chunk_no, ok, message) of the work items without pages, and of listings that
    ended early."""
    return _landed(spark, path, "miss").select("group_id", "obs_date", "chunk_no", "ok", "message")


# The request parameters the source passes to the vendor for monthly price series.
MONTHLY_REQUEST = {"calendar": "CAL_USBANK", "frequency": "FREQ_MONTH",
                   "conversion": "CONV_LASTBUS_ABS", "nan_treatment": "NA_NOTHING", "attributes": ["NO_ATTRIBUTE"]}


def instrument_chunks(ids: DataFrame, chunk_size: int = 20, bucket_target: int = 4) -> DataFrame:
    """W1 for instrument lists: ``(chunk_key, ids ARRAY<STRING>)`` with at most ``chunk_size`` ids
    per chunk, without a global window.

    Ids are hash-bucketed (about ``bucket_target`` chunks per bucket) and numbered inside their
    bucket only, so every window partition is small and the chunking is spread over tasks.
    """
    distinct = ids.select(F.col(ids.columns[0]).cast("string").alias("instrument_id")).distinct()
    n = distinct.count()                                   # one number, to size the buckets
    buckets = max(1, -(-n // (chunk_size * bucket_target)))
    from pyspark.sql import Window
    b = distinct.withColumn("bucket", F.pmod(F.xxhash64("instrument_id"), F.lit(buckets)))
    w = Window.partitionBy("bucket").orderBy("instrument_id")
    numbered = b.withColumn("sub", F.floor((F.row_number().over(w) - 1) / chunk_size))
    return (numbered.groupBy("bucket", "sub")
            .agg(F.array_sort(F.collect_list("instrument_id")).alias("ids"))
            .select(F.concat_ws(":", "bucket", "sub").alias("chunk_key"), "ids"))


def fetch_instrument_pages(ids: DataFrame, fetch, start_ymd: str, end_ymd: str, *, chunk_size: int = 20,
                           pass_no: int = 1, request: dict | None = None, tasks: int | None = None,
                           ingested_at: str | None = None) -> DataFrame:
    """X8's vendor step: call ``fetch(ids, start, end, pass_no, **request)`` once per chunk of
    at most ``chunk_size`` instrument ids, on the executors. A failing chunk becomes an attempt
    record (the source warned and skipped it); the others land as pages."""
    import pandas as pd

    params = dict(MONTHLY_REQUEST if request is None else request)

    def call(key, chunk):
        try:
            pages = [_landable(p, group_id=key, obs_date=end_ymd, page_no=i, request="full", ingested_at=ingested_at)
                     for i, p in enumerate(fetch([str(x) for x in chunk], start_ymd, end_ymd, pass_no, **params) or [])]
        except Exception as exc:  # noqa: BLE001 — a failed chunk is a record, not a lost job
            return [(key, None, None, None, None, False, f"{type(exc).__name__}: {exc}")]
        return [(key, end_ymd, None, i, p, True, None) for i, p in enumerate(pages)]

    names = [f.split()[0] for f in FETCH_SCHEMA.split(", ")]

    def run(batches):
        for pdf in batches:
            for key, chunk in zip(pdf["chunk_key"], pdf["ids"]):
                yield pd.DataFrame(call(key, chunk), columns=names).astype({"chunk_no": "Int32", "page_no": "Int32"})

    return _spread(instrument_chunks(ids, chunk_size), tasks, "chunk_key").mapInPandas(run, FETCH_SCHEMA)
