"""Shared pieces for the registered queries."""
from __future__ import annotations

from pyspark.sql import functions as F

from tessera.session import read_table

# The incremental run's default look-back when a group has no manifest rows (days).
DEFAULT_WINDOW_DAYS = 730


def event_span(spark, sf_dir):
    """(first, last) event day as Columns over **one** scalar subquery (no driver round trip).

    ``min``/``max`` run on the bare column (one scan for both; eligible for Parquet aggregate
    pushdown), and the day is taken afterwards.
    """
    ev = read_table(spark, sf_dir, "events")
    span = ev.select(F.struct(F.to_date(F.min("ts")).alias("s"), F.to_date(F.max("ts")).alias("e"))).scalar()
    return span["s"], span["e"]


SPAN_SQL = """span AS (SELECT min(CAST(ts AS DATE)) AS s, max(CAST(ts AS DATE)) AS e FROM events)"""


def bdays_sql(start: str, end: str) -> str:
    """DuckDB: business days between two DATE expressions as a table ``t(d)``."""
    return (f"(SELECT CAST(x AS DATE) AS d FROM generate_series(CAST({start} AS TIMESTAMP), "
            f"CAST({end} AS TIMESTAMP), INTERVAL 1 DAY) g(x) WHERE isodow(x) < 6)")
