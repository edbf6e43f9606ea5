import datetime as dt

from pyspark.sql import functions as F

from tessera import functions as TF


def one(spark, col):
    return spark.range(1).select(col.alias("x")).first()["x"]


def test_business_days_demo(spark):
    days = one(spark, TF.business_days("20240101", "20240110"))
    assert [d.strftime("%Y%m%d") for d in days] == [
        "20240101", "20240102", "20240103", "20240104", "20240105", "20240108", "20240109", "20240110"]


def test_business_days_empty_and_weekend(spark):
    assert one(spark, TF.business_days("20240110", "20240101")) == []
    assert one(spark, TF.business_days("20240106", "20240107")) == []


def test_explode_business_days_with_scalar_bounds(spark):
    bounds = spark.createDataFrame([(dt.date(2024, 1, 1), dt.date(2024, 1, 10))], "s date, e date")
    rows = TF.explode_business_days(spark.range(2), bounds.select(F.min("s")).scalar(),
                                    bounds.select(F.max("e")).scalar()).collect()
    assert len(rows) == 16


def test_months_back_and_helpers(spark):
    assert one(spark, TF.months_back(F.lit("20260331"), F.lit(6))) == "20250901"
    assert one(spark, TF.months_back(F.lit("20260115"), F.lit(1))) == "20251201"
    assert one(spark, TF.months_back(F.lit("20241331"), F.lit(0))) == "20250101"   # month 13 rolls over
    assert one(spark, TF.ymd_to_iso(F.lit("20240102"))) == "2024-01-02"
    assert one(spark, TF.iso_to_compact(F.lit("2024-01-02"))) == "20240102"
    assert one(spark, TF.next_day(F.lit("20240131"))) == "20240201"
    assert one(spark, TF.yesterday(F.lit("20240301"))) == "20240229"
    assert one(spark, TF.default_start(F.lit("20260101"))) == "20240102"  # 2024 is a leap year
    assert one(spark, TF.run_ts_text(F.lit("2024-01-02 03:04:05").cast("timestamp"))) == "20240102T030405"


def test_norm_date(spark):
    cases = {"20240103": "2024-01-03", "2024-01-04T00:00:00": "2024-01-04", "2024-1": "2024-1",
             "20241301": None}
    for raw, want in cases.items():
        assert one(spark, TF.norm_date(F.lit(raw))) == want
    assert one(spark, TF.norm_date(F.lit(None).cast("string"))) is None


def test_lenient_typing(spark):
    assert one(spark, TF.lenient_date(F.lit("bad"))) is None
    assert one(spark, TF.lenient_date(F.lit("2024-01-02"))) == dt.date(2024, 1, 2)
    assert one(spark, TF.lenient_timestamp(F.lit("nope"))) is None
