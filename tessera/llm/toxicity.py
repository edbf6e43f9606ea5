"""Toxicity: a character n-gram linear classifier on naive-Bayes-scaled features.

Features are the n-grams (n = 3 to 6 characters, here UTF-8 bytes, A-Z as a-z) of a document's
distinct words with a space on both sides, hashed to ``DIMS`` places; a feature's value is the
number of times that its distinct words hold it. Every feature is scaled by its naive Bayes log-count ratio
``r = log((pos + a) / (rho * neg + a))`` (``rho`` levels the classes' total counts, so an unseen
n-gram has r = 0), features with ``|r|`` under ``LEAST_RATIO`` are left out, and a logistic
regression with an L2 penalty is fitted on the scaled features.

Fitting uses a bounded sample of the labelled rows: at most ``PER_CLASS`` documents a class for the
counts and ``FIT_PER_CLASS`` of them for the regression (smallest hashes of doc_id). Scoring covers
every whole text.
"""
from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from tessera.llm import textvec as tv
from tessera.llm.common import hash_limit, written

SIZES = (3, 4, 5, 6)
BITS = 20
DIMS = 1 << BITS
CHUNK = 1 << 12             # places per row when counts are added up
SMOOTH = 1.0
LEAST_RATIO = 1.0
PER_CLASS = 20_000
FIT_PER_CLASS = 2_000
TABLE_BITS = 20


def word_grams(data: np.ndarray, starts: np.ndarray, ends: np.ndarray):
    """n-grams of words given by byte ranges: per size (feature place, number of the word), both in
    the order of the words."""
    size = ends - starts + 2
    first = np.cumsum(size) - size
    total = int(size.sum())
    if not total:
        return []
    word = np.repeat(np.arange(len(starts)), size)
    inside = np.arange(total) - first[word]
    left = size[word] - inside                      # bytes from here to the word's end
    edge = (inside == 0) | (left == 1)
    raw = tv.LOWER[data[np.where(edge, 0, starts[word] + inside - 1)]]
    raw[edge] = 32
    v = tv.BYTE_TABLE[raw]
    h = np.zeros(total, np.uint64)
    out = []
    for n in range(1, max(SIZES) + 1):
        m = total - n + 1
        if m <= 0:
            break
        h[:m] *= tv._STEP
        h[:m] += v[n - 1:]
        if n in SIZES:
            at = np.flatnonzero(left >= n)
            out.append(((tv.mix(h[at] + np.uint64(n)) >> np.uint64(64 - BITS)).astype(np.int64), word[at]))
    return out


def distinct_words(data: np.ndarray, offsets: np.ndarray):
    """Distinct words of each text of a slice: (doc, word) pairs, and the words' byte ranges."""
    h, before, starts, ends = tv.word_hashes(data, offsets)
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(before))
    _, at, word = np.unique(h, return_index=True, return_inverse=True)
    pair = np.unique(doc * max(1, len(at)) + word)
    lo = int(offsets[0])
    return pair // max(1, len(at)), pair % max(1, len(at)), starts[at] + lo, ends[at] + lo


def doc_features(data: np.ndarray, offsets: np.ndarray):
    """Feature counts of each text: (doc, place) of every distinct word's n-grams."""
    doc, word, starts, ends = distinct_words(data, offsets)
    docs, places = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for place, of in word_grams(data, starts, ends):
        first = np.searchsorted(of, np.arange(len(starts) + 1))
        n = np.diff(first)[word]
        at = np.repeat(first[word] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        docs.append(np.repeat(doc, n))
        places.append(place[at])
    return np.concatenate(docs), np.concatenate(places)


def labelled_sample(docs: DataFrame, labels: DataFrame, learn, per_class: int = PER_CLASS,
                    fit_per_class: int = FIT_PER_CLASS) -> DataFrame:
    """At most ``per_class`` labelled documents a class: (text, toxic, fit), written once.

    A doc_id labelled more than once counts as toxic if any label says so; null labels, null
    doc_ids and labels other than 0 and 1 are left out. ``learn`` is a condition on doc_id.
    """
    known = (labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1)).where(learn)
             .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic")))
    n = {r[0]: r[1] for r in known.groupBy("toxic").count().collect()}          # two rows
    at = F.xxhash64("doc_id")
    chosen = None
    for toxic in (0, 1):
        # a hash threshold first, so that the sort sees a few times the bound whatever the input
        share = 2.0 * per_class / max(1, n.get(toxic, 0)) + 0.001
        part = (known.where((F.col("toxic") == toxic) & (at <= F.lit(hash_limit(share))))
                .orderBy(at, "doc_id").limit(per_class))
        chosen = part if chosen is None else chosen.unionByName(part)
    chosen = chosen.withColumn("fit", F.row_number().over(
        W.partitionBy("toxic").orderBy(at, "doc_id")) <= fit_per_class)
    # at most 2 * per_class rows of three small columns
    return written(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
                   .select("text", "toxic", "fit"), "toxic-sample")


def class_counts(sample: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """n-gram counts of the toxic and the clean documents of the sample (DIMS numbers each)."""

    def count(batches):
        sums = np.zeros((2, DIMS))
        for batch in batches:
            for part in tv.bounded_slices(batch, "text"):
                doc, place = doc_features(*tv.utf8(part.column("text")))
                toxic = part.column("toxic").to_numpy(zero_copy_only=False)[doc] if len(doc) else doc
                for y in (0, 1):
                    sums[y] += np.bincount(place[toxic == y], minlength=DIMS)
        out = sums.astype(np.float32)
        for k in range(DIMS // CHUNK):
            piece = out[:, k * CHUNK:(k + 1) * CHUNK]
            if piece.any():
                yield pa.RecordBatch.from_pydict({"chunk": pa.array([k], pa.int32()),
                                                  "counts": pa.array([piece.tobytes()], pa.binary())})

    def add(key, table):
        total = sum(np.frombuffer(x.as_py(), np.float32) for x in table.column("counts"))
        return pa.table({"chunk": [key[0].as_py()], "counts": [total.astype(np.float32).tobytes()]},
                        schema=pa.schema([("chunk", pa.int32()), ("counts", pa.binary())]))

    schema = "chunk int, counts binary"
    added = sample.mapInArrow(count, schema).groupBy("chunk").applyInArrow(add, schema)
    sums = np.zeros((2, DIMS), np.float32)
    for r in added.collect():                       # DIMS * 8 bytes, whatever the input
        sums[:, r.chunk * CHUNK:(r.chunk + 1) * CHUNK] = np.frombuffer(r.counts, np.float32).reshape(2, -1)
    return sums[1], sums[0]


def log_ratios(pos: np.ndarray, neg: np.ndarray) -> np.ndarray:
    rho = max(pos.sum(), 1.0) / max(neg.sum(), 1.0)
    r = np.log((pos + SMOOTH) / (neg * rho + SMOOTH))
    return np.where(np.abs(r) >= LEAST_RATIO, r, 0).astype(np.float32)


def fit_logistic(row: np.ndarray, place: np.ndarray, value: np.ndarray, y: np.ndarray,
                 l2: float = 1e-4, steps: int = 300, rate: float = 0.05) -> tuple[np.ndarray, float]:
    """L2 logistic regression on a sparse sample (Adam, whole batches, classes weighted evenly)."""
    used, col = np.unique(place, return_inverse=True)
    w, b = np.zeros(len(used)), 0.0
    m, s = np.zeros(len(used) + 1), np.zeros(len(used) + 1)
    weight = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum()))
    for t in range(1, steps + 1):
        z = np.bincount(row, value * w[col], minlength=len(y)) + b
        g = weight * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y)
        grad = np.append(np.bincount(col, value * g[row], minlength=len(used)) + l2 * w, g.sum())
        m, s = 0.9 * m + 0.1 * grad, 0.99 * s + 0.01 * grad ** 2
        step = rate * (m / (1 - 0.9 ** t)) / (np.sqrt(s / (1 - 0.99 ** t)) + 1e-8)
        w, b = w - step[:-1], b - step[-1]
    full = np.zeros(DIMS)
    full[used] = w
    return full, float(b)


def fit(sample: DataFrame) -> tuple[np.ndarray, float]:
    """Weights (log-count ratio times regression weight, DIMS floats) and bias."""
    ratio = log_ratios(*class_counts(sample))
    shared = sample.sparkSession.sparkContext.broadcast(ratio)      # DIMS * 4 bytes

    def features(batches):
        for batch in batches:
            for part in tv.bounded_slices(batch, "text"):
                doc, place = doc_features(*tv.utf8(part.column("text")))
                keep = shared.value[place] != 0
                key, n = np.unique(doc[keep] << BITS | place[keep], return_counts=True)
                first = np.searchsorted(key >> BITS, np.arange(part.num_rows + 1))
                cut = lambda x: [x[first[i]:first[i + 1]].tobytes() for i in range(part.num_rows)]
                yield pa.RecordBatch.from_pydict({
                    "toxic": part.column("toxic").cast(pa.int32()),
                    "place": pa.array(cut((key & (DIMS - 1)).astype(np.int32)), pa.binary()),
                    "n": pa.array(cut(n.astype(np.float32)), pa.binary())})

    # at most 2 * FIT_PER_CLASS documents
    got = sample.where("fit").select("text", "toxic").mapInArrow(
        features, "toxic int, place binary, n binary").collect()
    y = np.array([r.toxic for r in got], float)
    if len(set(y.tolist())) < 2:                    # one class or none: its share is the score
        return np.zeros(DIMS, np.float32), (30.0 if y.mean() else -30.0) if len(y) else 0.0
    places = [np.frombuffer(r.place, np.int32) for r in got]
    row = np.repeat(np.arange(len(got)), [len(p) for p in places])
    place = np.concatenate(places)
    value = np.concatenate([np.frombuffer(r.n, np.float32) for r in got]) * ratio[place]
    w, b = fit_logistic(row, place, value, y)
    return (w * ratio).astype(np.float32), b


_tables: dict[str, tuple[np.ndarray, np.ndarray]] = {}      # of this Python worker, for the last model


def score(docs: DataFrame, weights: np.ndarray, bias: float, text: str = "text",
          out: str = "score", keep: tuple[str, ...] | None = None) -> DataFrame:
    """Add the toxicity score (0 to 1) of every whole text (with the columns ``keep``).

    Null and empty texts have no n-gram: their score is the bias alone.
    """
    from pyspark.sql import types as T
    shared = docs.sparkSession.sparkContext.broadcast(weights)
    model = uuid.uuid4().hex
    keep = [c for c in keep or docs.columns if c != out]
    schema = T.StructType([*docs.select(*keep).schema.fields, T.StructField(out, T.DoubleType())])

    def scored(batches):
        if model not in _tables:                            # direct-mapped table word -> weight
            _tables.clear()
            _tables[model] = np.zeros(1 << TABLE_BITS, np.uint64), np.zeros(1 << TABLE_BITS)
        key, val = _tables[model]
        for batch in batches:
            for part in tv.bounded_slices(batch, text):
                data, offsets = tv.utf8(part.column(text))
                h, before, starts, ends = tv.word_hashes(data, offsets)
                slot = (h >> np.uint64(64 - TABLE_BITS)).astype(np.int64)
                own = val[slot]
                miss = np.flatnonzero(key[slot] != h)
                if len(miss):
                    new, at, back = np.unique(h[miss], return_index=True, return_inverse=True)
                    at = miss[at]
                    got = np.zeros(len(at))
                    for place, of in word_grams(data, starts[at] + int(offsets[0]), ends[at] + int(offsets[0])):
                        got += np.bincount(of, shared.value[place], minlength=len(at))
                    own[miss] = got[back]
                    key[slot[at]], val[slot[at]] = new, got
                doc = np.repeat(np.arange(part.num_rows), np.diff(before))
                some = np.flatnonzero(own)
                order = some[np.lexsort((h[some], doc[some]))]
                once = np.ones(len(order), dtype=bool)
                once[1:] = (h[order][1:] != h[order][:-1]) | (doc[order][1:] != doc[order][:-1])
                order = order[once]
                z = np.bincount(doc[order], own[order], minlength=part.num_rows) + bias
                p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in keep], pa.array(p, pa.float64())],
                                                 names=[*keep, out])

    return docs.mapInArrow(scored, schema)
