from tessera.functions import classify_failure, classify_failure_words, is_no_content

DEMO = {
    "429 too many requests": ("rate_limit", "long_backoff", 180),
    "401 unauthorized": ("auth_error", "sleep_and_retry", 60),
    "204 no content": ("empty_payload", "skip", 0),
    "connection timed out": ("timeout", "long_backoff", 90),
    "unknown error xyz": ("unknown", "std_backoff", 30),
    "empty_payload: 0 rows returned": ("empty_payload", "skip", 0),
    "validation failed": ("validation_failed", "retry", 15),
    "volume_write_error: x 20240102 y": ("auth_error", "sleep_and_retry", 60),
    "": ("unknown", "std_backoff", 30),
}


def test_classify_demo_and_derived(spark):
    df = spark.createDataFrame([(k,) for k in DEMO] + [(None,)], "m string")
    got = {r["m"]: (r["c"]["category"], r["c"]["strategy"], r["c"]["wait_s"])
           for r in df.select("m", classify_failure("m").alias("c")).collect()}
    for k, v in DEMO.items():
        assert got[k] == v, k
    assert got[None] == ("unknown", "std_backoff", 30)


def test_word_variant_and_no_content(spark):
    df = spark.createDataFrame([("volume_write_error: x 20240102 y",), ("HTTP 401",)], "m string")
    rows = df.select(classify_failure_words("m")["category"].alias("c")).collect()
    assert [r["c"] for r in rows] == ["unknown", "auth_error"]
    df2 = spark.createDataFrame([("No Content",), ("{'code': '204'}",), ("field required: instruments",), ("boom",)], "m string")
    assert [r[0] for r in df2.select(is_no_content("m")).collect()] == [True, True, True, False]
