"""R1-R3 queries (semantics inferred from request parameter names; see operators.resample)."""
from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import resample
from tessera.queries import analogues as A
from tessera.queries.common import event_span
from tessera.registry import query

# Fixed values (test calendar, ours): holidays inside the events month.
HOLIDAYS = ["2024-01-01", "2024-01-08", "2024-01-15"]


@query("r1_monthly_last_business", A.with_views("v1") + """
SELECT group_id, instrument, attribute, month, value, as_of FROM (
  SELECT group_id, instrument, attribute, CAST(date_trunc('month', date) AS DATE) AS month, value,
         max(date) OVER (PARTITION BY group_id, instrument, attribute, date_trunc('month', date)) AS as_of,
         row_number() OVER (PARTITION BY group_id, instrument, attribute, date_trunc('month', date)
                            ORDER BY date DESC, ingested_at DESC) AS rn
  FROM v1 WHERE isodow(date) < 6) WHERE rn = 1""")
def monthly_q(spark, sf_dir):
    return resample.monthly_last_business(A.observations(spark, sf_dir)).select(
        "group_id", "instrument", "attribute", "month", "value", "as_of")


@query("r2_holiday_business_days", A.with_views("v1") + f""",
span AS (SELECT min(CAST(ts AS DATE)) AS s, max(CAST(ts AS DATE)) AS e FROM events)
SELECT g.group_id, CAST(x AS DATE) AS obs_date
FROM (SELECT DISTINCT group_id FROM v1) g, span,
     generate_series(CAST(span.s AS TIMESTAMP), CAST(span.e AS TIMESTAMP), INTERVAL 1 DAY) t(x)
WHERE isodow(x) < 6 AND CAST(x AS DATE) NOT IN ({", ".join(f"DATE '{h}'" for h in HOLIDAYS)})""")
def holidays_q(spark, sf_dir):
    v1 = A.observations(spark, sf_dir)
    start, end = event_span(spark, sf_dir)
    hol = spark.createDataFrame([(h,) for h in HOLIDAYS], "holiday string")
    return resample.business_days_except(v1.select("group_id").distinct(), start, end, hol).select(
        "group_id", "obs_date")


# Fixed values (test calendars, ours): month and day of the holidays of every year, some at month ends.
CALENDARS = {"CAL_EVEN": ["01-01", "05-31", "07-04", "12-25", "12-31"],
             "CAL_ODD": ["03-29", "03-30", "03-31", "08-31", "12-29", "12-30", "12-31"]}
_HOLIDAYS_SQL = ", ".join(f"('{c}', '{d}')" for c, days in CALENDARS.items() for d in days)


@query("r1_calendar_month_end", A.with_views("v6") + f""",
obs AS (SELECT instrument_id, CASE WHEN l_partkey % 2 = 0 THEN 'CAL_EVEN' ELSE 'CAL_ODD' END AS calendar,
               CAST(date AS DATE) AS date, value FROM v6
        QUALIFY row_number() OVER (PARTITION BY instrument_id, date ORDER BY l_orderkey DESC, l_linenumber DESC) = 1),
span AS (SELECT date_trunc('month', min(date)) AS s, last_day(max(date)) AS e FROM obs),
hol(calendar, md) AS (VALUES {_HOLIDAYS_SQL}),
days AS (SELECT c.calendar, CAST(x AS DATE) AS day FROM (SELECT DISTINCT calendar FROM hol) c, span,
         generate_series(CAST(s AS TIMESTAMP), CAST(e AS TIMESTAMP), INTERVAL 1 DAY) t(x)
         WHERE isodow(x) < 6 AND (c.calendar, strftime(x, '%m-%d')) NOT IN (SELECT (calendar, md) FROM hol)),
ends AS (SELECT *, lag(month_end) OVER (PARTITION BY calendar ORDER BY month) AS before FROM (
         SELECT calendar, CAST(date_trunc('month', day) AS DATE) AS month, max(day) AS month_end FROM days GROUP BY ALL)),
keyed AS (SELECT instrument_id, calendar, min(date) AS lo, max(date) AS hi FROM obs GROUP BY ALL),
grid AS (SELECT k.instrument_id, e.* FROM keyed k JOIN ends e ON k.calendar = e.calendar AND e.month_end >= k.lo
         AND (e.before IS NULL OR e.before < k.hi))
SELECT g.instrument_id, g.calendar, g.month, g.month_end, o.date AS as_of, o.value
FROM grid g ASOF JOIN obs o ON g.instrument_id = o.instrument_id AND g.month_end >= o.date""")
def calendar_month_end_q(spark, sf_dir):
    """Month-end prices of every instrument as of its own calendar's last business day."""
    obs = A.price_points(spark, sf_dir).select(
        "instrument_id", F.when(F.col("l_partkey") % 2 == 0, "CAL_EVEN").otherwise("CAL_ODD").alias("calendar"),
        F.to_date("date").alias("date"), "value", "l_orderkey", "l_linenumber")
    span = obs.select(F.struct(F.min("date").alias("s"), F.max("date").alias("e"))).scalar()
    days = spark.createDataFrame([(c, d) for c, days in CALENDARS.items() for d in days], "calendar string, md string")
    holidays = days.select("calendar", F.explode(F.sequence(F.year(span["s"]), F.year(span["e"]))).alias("y"), "md").select(
        "calendar", F.to_date(F.concat_ws("-", "y", "md")).alias("holiday"))
    ends = resample.month_ends(holidays, span["s"], span["e"])
    return resample.last_business_values(obs, ends, tiebreak=("l_orderkey", "l_linenumber"))


@query("r3_null_treatment", A.with_views("v1") + """
SELECT group_id, instrument, attribute, date, value FROM v1 WHERE value IS NOT NULL""")
def null_treatment_q(spark, sf_dir):
    return resample.null_treatment(A.observations(spark, sf_dir), "drop").select(
        "group_id", "instrument", "attribute", "date", "value")
