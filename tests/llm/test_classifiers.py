"""Toxicity and language ID: held-out accuracy on driver tables, kernel identity, hostile rows."""
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tessera.llm import langid, textvec as tv, toxicity
from tessera.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def test_language_held_out_accuracy(spark):
    got = QUERIES["op10_language_id"](spark, SF)
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    j = got.join(docs, "doc_id").where("held_out").select((F.col("lang") == F.col("lang_pred")).cast("int").alias("ok"))
    assert got.count() == docs.count()
    assert j.agg(F.avg("ok")).first()[0] > 0.98


def test_presence_rows_are_distinct_hashed_ngrams():
    texts = ["abcab", "", None, "Ab", "é x"]
    rows = langid.presence(*tv.utf8(pa.array(texts)))
    for t, row in zip(texts, rows):
        raw = bytes(tv.LOWER[np.frombuffer((t or "").encode(), np.uint8)])
        grams = {raw[i:i + n] for n in langid.SIZES for i in range(len(raw) - n + 1)}
        assert (langid.presence(*tv.utf8(pa.array([t], pa.string())))[0] == row).all()
        assert row.sum() <= len(grams) and (len(grams) == 0) == (row.sum() == 0)
    assert (rows[0] >= rows[3]).all()           # "ab" is part of "abcab", case does not count


def test_fold_equals_kernel_times_weights():
    """Scoring by the folded matrix is the kernel with the landmarks times their weights."""
    rng = np.random.default_rng(0)
    p = (rng.random((6, langid.DIMS)) < 0.01).astype(np.float32)
    land = (rng.random((4, langid.DIMS)) < 0.01).astype(np.float32)
    land /= np.sqrt(land.sum(1, keepdims=True))
    a = rng.normal(size=(4, 3)).astype(np.float32)
    kernel = (p @ land.T) / np.sqrt(p.sum(1, keepdims=True))
    assert np.allclose(kernel @ a, (p @ (land.T @ a)) / np.sqrt(p.sum(1, keepdims=True)), atol=1e-4)


def test_language_hostile_rows(docs, rows, empty):
    langs, weights = langid.fit(docs, F.lit(True))
    assert langs == ["en", "fr"]
    got = langid.predict(docs, langs, weights)
    assert got.columns == [c for c in docs.columns if c != "score"] + ["lang_pred", "score"]
    for r in got.collect():
        und = r.text is None or not any(map(str.isalpha, r.text))
        assert (r.lang_pred == "und") == und and 0 <= r.score <= 1 and (r.score == 0) == und
    assert langid.fit(empty, F.lit(True))[0] == [] and langid.predict(empty, langs, weights).count() == 0
    none = langid.predict(docs, *langid.fit(docs.where("false"), F.lit(True)))
    assert {r.lang_pred for r in none.collect()} == {"und"}


def test_toxicity_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    got = QUERIES["op2_toxicity"](spark, sf)
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "toxic")
    r = got.join(labels, "doc_id").where("held_out").agg(
        F.avg((F.col("predicted") == F.col("toxic")).cast("int")).alias("accuracy"),
        F.avg(F.when(F.col("toxic") == 1, F.col("predicted"))).alias("recall"),
        F.avg(F.when(F.col("toxic") == 0, F.col("predicted"))).alias("false")).first()
    assert r.accuracy > 0.97 and r.recall > 0.88 and r.false < 0.02


def test_word_grams_are_padded_byte_ngrams():
    data = np.frombuffer(b"xx Clown yy", np.uint8)
    grams = toxicity.word_grams(data, np.array([3]), np.array([8]))
    assert [len(p) for p, _ in grams] == [max(0, len(" clown ") - n + 1) for n in toxicity.SIZES]
    lower = toxicity.word_grams(np.frombuffer(b"clown", np.uint8), np.array([0]), np.array([5]))
    assert all((a[0] == b[0]).all() for a, b in zip(grams, lower))


def test_log_ratios():
    pos, neg = np.array([0.0, 8, 0, 50]), np.array([0.0, 0, 400, 500])
    r = toxicity.log_ratios(pos, neg)
    assert r[0] == 0 and r[1] > 0 and r[2] < 0 and r[3] == 0        # unseen, toxic, clean, alike


@pytest.fixture
def marked(spark):
    rows = [(i, f"plain words number {i} and more " + ("awfulness" if i % 3 == 0 else "kindness")) for i in range(120)]
    rows += [(500, None), (501, ""), (None, "no id"), (502, "deep awfulnesses here"), (503, "x " * 20000)]
    labels = [(i, 1 if i % 3 == 0 else 0) for i in range(100)] + [(0, 0), (7, None), (None, 1), (9, 5)]
    return (spark.createDataFrame(rows, "doc_id long, text string").withColumn("score", F.lit("clash")),
            spark.createDataFrame(labels, "doc_id long, toxic int"))


def test_toxicity_learns_stems_and_handles_hostile_rows(marked, empty):
    docs, labels = marked
    weights, bias = toxicity.fit(toxicity.labelled_sample(docs, labels, F.lit(True)))
    got = {(r.doc_id, r.text): r.score for r in toxicity.score(docs, weights, bias).collect()}
    assert len(got) == 125 and all(0 <= s <= 1 for s in got.values())
    assert all((s >= 0.5) == ("awful" in (t or "")) for (d, t), s in got.items())
    assert got[(500, None)] == got[(501, "")]
    assert toxicity.score(empty, weights, bias).count() == 0
    w, b = toxicity.fit(toxicity.labelled_sample(docs, labels.where("false"), F.lit(True)))
    assert {r.score for r in toxicity.score(docs, w, b).collect()} == {0.5}
    w, b = toxicity.fit(toxicity.labelled_sample(docs, labels.where("toxic = 1"), F.lit(True)))
    assert all(r.score > 0.99 for r in toxicity.score(docs, w, b).collect())
