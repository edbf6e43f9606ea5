"""Language identification by string kernels, Nystroem landmarks and kernel ridge regression.

The kernel is the blended-spectrum presence kernel: the number of distinct n-grams (n = 1 to 4
bytes of the lower-cased text, all lengths together) that two texts share, divided by the root of
the product of their own counts. An n-gram is hashed to one of ``DIMS`` places, a text's presence
vector is a row of zeros and ones, and a batch of kernel values is a matrix product of presence
rows. One-versus-rest ridge regression is fitted in the Nystroem space of at most ``LANDMARKS``
landmark texts: ``a = (K_nm' K_nm + l n K_mm)^-1 K_nm' Y``. As the kernel is a product of presence
rows, ``K(x, landmarks) a = P(x) (P(landmarks)' a)``: the bracket is folded once into a DIMS x
languages matrix, and a batch of documents is scored by one matrix product.

Fitting uses a bounded sample of labelled rows: at most ``PER_LANG`` documents a language
(``FIT_ROWS`` in all), chosen by the smallest hashes of doc_id. Scoring covers every whole text.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F, types as T

from tessera.llm import textvec as tv
from tessera.llm.common import hash_limit, rows

SIZES = (1, 2, 3, 4)
BITS = 15
DIMS = 1 << BITS
PER_LANG = 240
FIT_ROWS = 8_000
LANDMARKS = 256
MAX_LANGS = 400             # the most frequent labels learned
RIDGE = 1e-4
SHARP = 10.0                # slope of the softmax that turns outputs into a score
ROWS = 128                  # texts in one matrix product
UNDETERMINED = "und"


def presence(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Presence rows (texts x DIMS, float32) of a slice's texts."""
    lo, hi = int(offsets[0]), int(offsets[-1])
    out = np.zeros((len(offsets) - 1, DIMS), np.float32)
    n = hi - lo
    if not n:
        return out
    v = tv.BYTE_TABLE[tv.LOWER[data[lo:hi]]]
    rel = offsets - lo
    doc = np.repeat(np.arange(len(offsets) - 1) << BITS, np.diff(offsets))
    flat = out.reshape(-1)
    left = np.repeat(rel[1:], np.diff(offsets)) - np.arange(n)
    h = np.zeros(n, np.uint64)
    for size in SIZES:
        m = n - size + 1
        if m <= 0:
            break
        h[:m] *= tv._STEP
        h[:m] += v[size - 1:]
        code = (tv.mix(h[:m] + np.uint64(size)) >> np.uint64(64 - BITS)).astype(np.int64)
        code += doc[:m]
        flat[code if size == 1 else code[left[:m] >= size]] = 1
    return out


def has_letter(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Whether a text has a letter (Unicode); most are decided by an ASCII letter."""
    lo = int(offsets[0])
    raw = data[lo:int(offsets[-1])]
    ascii_letter = np.concatenate([[0], np.cumsum((tv.LOWER[raw] >= 97) & (tv.LOWER[raw] <= 122))])
    rel = offsets - lo
    found = ascii_letter[rel[1:]] > ascii_letter[rel[:-1]]
    for i in np.flatnonzero(~found & (np.diff(rel) > 0)):
        found[i] = any(map(str.isalpha, raw[rel[i]:rel[i + 1]].tobytes().decode("utf-8", "replace")))
    return found


def fit(docs: DataFrame, learn) -> tuple[list[str], np.ndarray]:
    """(languages, weights DIMS x languages) from the rows of ``docs(doc_id, text, lang)`` for which
    the condition ``learn`` holds; null texts and null languages are left out."""
    spark = docs.sparkSession
    usable = docs.where(learn).where("lang is not null and text is not null")
    # one row per label, at most MAX_LANGS
    found = usable.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(MAX_LANGS).collect()
    if not found:
        return [], np.zeros((DIMS, 0), np.float32)
    langs = sorted(r[0] for r in found)
    each = max(8, min(PER_LANG, FIT_ROWS // len(langs)))
    at = F.xxhash64("doc_id")
    share = rows(spark, [{"lang": r[0], "_most": hash_limit(4.0 * each / r[1])}
                         for r in found], "lang string, _most long")
    # the hash threshold leaves about 4 * `each` rows of a language before anything is sorted
    sample = (usable.select("doc_id", "text", "lang").join(F.broadcast(share), "lang")
              .where(at <= F.col("_most")).withColumn("_n", F.row_number().over(
                  W.partitionBy("lang").orderBy(at, "doc_id", F.xxhash64("text"))))
              .where(F.col("_n") <= each).select("text", "lang", "_n"))

    def bits(batches):
        for batch in batches:
            for part in tv.bounded_slices(batch, "text", 1 << 20):
                for k in range(0, part.num_rows, ROWS):
                    some = part.slice(k, ROWS)
                    rows_ = np.packbits(presence(*tv.utf8(some.column("text"))) > 0, axis=1)
                    yield pa.RecordBatch.from_pydict({
                        "lang": some.column("lang"), "n": some.column("_n").cast(pa.int32()),
                        "bits": pa.array([r.tobytes() for r in rows_], pa.binary())})

    # at most FIT_ROWS rows of DIMS / 8 bytes
    got = sorted(sample.mapInArrow(bits, "lang string, n int, bits binary").collect(),
                 key=lambda r: (r.n, r.lang, r.bits))
    p = np.unpackbits(np.frombuffer(b"".join(r.bits for r in got), np.uint8).reshape(len(got), -1),
                      axis=1).astype(np.float32)
    p /= np.sqrt(np.maximum(p.sum(1, keepdims=True), 1))
    y = np.where(np.array([[r.lang == x for x in langs] for r in got]), 1.0, -1.0)
    land = p[:LANDMARKS]                    # the sample is ordered by rank: languages alternate
    k_nm = (p @ land.T).astype(float)
    k_mm = (land @ land.T).astype(float)
    system = k_nm.T @ k_nm + RIDGE * len(p) * k_mm + 1e-9 * len(p) * np.eye(len(land))
    weights = land.T @ np.linalg.solve(system, k_nm.T @ y).astype(np.float32)
    return langs, weights.astype(np.float32)


def predict(docs: DataFrame, langs: list[str], weights: np.ndarray, text: str = "text",
            names: tuple[str, str] = ("lang_pred", "score"), keep: tuple[str, ...] | None = None) -> DataFrame:
    """Add the predicted language and a score (0 to 1) to every row (with the columns ``keep``).

    A null text, a text without a letter, and every text when nothing was learned get ``und`` with
    score 0. Equal outputs go to the language that sorts first.
    """
    keep = [c for c in keep or docs.columns if c not in names]
    schema = T.StructType([*docs.select(*keep).schema.fields, T.StructField(names[0], T.StringType()),
                           T.StructField(names[1], T.DoubleType())])
    shared = docs.sparkSession.sparkContext.broadcast(weights)     # DIMS x languages

    def predicted(batches):
        for batch in batches:
            for part in tv.bounded_slices(batch, text, 1 << 20):
                for k in range(0, part.num_rows, ROWS):
                    some = part.slice(k, ROWS)
                    data, offsets = tv.utf8(some.column(text))
                    rows_ = presence(data, offsets)
                    known = has_letter(data, offsets) & bool(langs)
                    best, score = np.zeros(len(rows_), int), np.zeros(len(rows_))
                    if langs:
                        f = rows_ @ shared.value
                        f /= np.sqrt(np.maximum(rows_.sum(1, keepdims=True), 1))
                        e = np.exp(SHARP * (f - f.max(1, keepdims=True)))
                        best, score = f.argmax(1), (e.max(1) / e.sum(1)).astype(float)
                    yield pa.RecordBatch.from_arrays(
                        [*[some.column(c) for c in keep],
                         pa.array([langs[b] if ok else UNDETERMINED for b, ok in zip(best, known)], pa.string()),
                         pa.array(np.where(known, score, 0.0), pa.float64())],
                        names=[*keep, *names])

    return docs.mapInArrow(predicted, schema)
