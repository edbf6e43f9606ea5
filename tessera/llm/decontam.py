"""Benchmark decontamination: n-gram seeds, then Smith-Waterman alignment.

Words are runs of letters and digits (bytes other than ASCII marks and white space) of the
lower-cased text, compared by 64-bit hashes; an item's seeds are word 3-grams.

1. Seeds: the rare 3-grams of an item. A first pass counts in how many documents each occurs. Those of at most
   ``RARE_LEAST`` documents, or one in ``RARE_SHARE``, are seeds; of the others those that, among ``WINDOW``
   consecutive 3-grams of the item, occur at most ``NEAR_RAREST`` times as often as the rarest one that occurs at
   all. So phrases that everyone uses are no seeds beside rarer ones, an item that a third of the corpus copies
   keeps its 3-grams, and 3-grams that no document holds (an edited copy breaks some) decide nothing.
2. Passages: one pass finds seeds in the documents (through a bitmap) and emits the words around
   them, once per cluster of seeds. A passage meets the items of its seeds in a join.
3. Alignment: Smith-Waterman over words (match 2, mismatch and gap -1) of item and passage. The
   score divided by the item's best possible score is the similarity; from ``MIN_SCORE`` on it is a
   leak. Dropped, changed and added words cost, they do not break the match. Pairs of which too few
   item words occur in the passage for that score are not aligned; this bound loses nothing.

Bitmaps have a fixed size, so they can be sent to every task whatever the benchmark's size; what
passes one is checked by the joins. Items with equal words are aligned once. Items of fewer than
three words are no evidence and never reported; null and empty texts match nothing. Documents are
told apart by doc_id and text, so repeated and null doc_ids are fine.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window as W, functions as F

from tessera.llm import textvec as tv
from tessera.llm.common import fresh, written

GRAM = 3
WINDOW = 4                  # consecutive 3-grams of an item among which the rarest stay
RARE_LEAST, RARE_SHARE = 100, 1000      # documents that hold a rare 3-gram: at most 100, or one in 1,000
NEAR_RAREST = 2.0
MATCH, MISMATCH, GAP = 2, -1, -1
MIN_SCORE = 0.5
BITMAP_BITS = 24
LONGEST_PASSAGE = 4096      # words after which a cluster of seeds is cut (with overlap)

SEPARATES = np.zeros(256, dtype=bool)
SEPARATES[:128] = True
SEPARATES[[*range(48, 58), *range(65, 91), *range(97, 123)]] = False


def words(column) -> tuple[np.ndarray, np.ndarray]:
    """(word hashes, words before each text) of a string column."""
    h, before, _, _ = tv.word_hashes(*tv.utf8(pc.utf8_lower(column)), separates=SEPARATES)
    return h, before


def item_words(items: DataFrame) -> DataFrame:
    """(item, words): one row per distinct word sequence of at least three words."""

    def rows(batches):
        for batch in batches:
            for part in tv.bounded_slices(batch, "text"):
                h, before = words(part.column("text"))
                cut = [h[before[i]:before[i + 1]] for i in range(part.num_rows)]
                yield pa.RecordBatch.from_pydict({
                    "item_id": part.column("item_id").cast(pa.int64()),
                    "item": pa.array([int(tv.sequence_hash(c).view(np.int64)) for c in cut], pa.int64()),
                    "words": pa.array([c.tobytes() if len(c) >= GRAM else None for c in cut], pa.binary())})

    return (items.select("item_id", "text").mapInArrow(rows, "item_id long, item long, words binary")
            .where("words is not null"))


def item_grams(items: DataFrame) -> DataFrame:
    """(item, at, gram) of ``items(item, words)``: the 3-gram that starts at each word."""

    def rows(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                h = np.frombuffer(batch.column("words")[k].as_py(), np.uint64)
                g = tv.combine(h, GRAM).view(np.int64)
                yield pa.RecordBatch.from_pydict({
                    "item": pa.array([batch.column("item")[k].as_py()] * len(g), pa.int64()),
                    "at": pa.array(np.arange(len(g))), "gram": pa.array(g, pa.int64())})

    return items.select("item", "words").mapInArrow(rows, "item long, at long, gram long")


def gram_counts(docs: DataFrame, grams: DataFrame, text: str) -> DataFrame:
    """(gram, n): in how many documents each of ``grams(gram)`` occurs; those that occur in none are left out."""
    bits = docs.sparkSession.sparkContext.broadcast(bitmap(grams, "gram"))     # fixed size

    def rows(batches):
        for batch in batches:
            for part in tv.bounded_slices(batch, "text"):
                h, before = words(part.column("text"))
                g, at, _ = tv.word_ngrams(h, before, GRAM)
                hit = np.flatnonzero(passes(bits.value, g))
                doc = np.searchsorted(before, at[hit], side="right") - 1
                order = np.lexsort((g[hit], doc))
                doc, gram = doc[order], g[hit][order]
                new = np.ones(len(gram), bool)
                new[1:] = (doc[1:] != doc[:-1]) | (gram[1:] != gram[:-1])       # once a document
                gram, n = np.unique(gram[new], return_counts=True)
                yield pa.RecordBatch.from_pydict({"gram": pa.array(gram.view(np.int64)), "n": pa.array(n.astype(np.int64))})

    return (docs.select(F.col(text).alias("text")).mapInArrow(rows, "gram long, n long")
            .groupBy("gram").agg(F.sum("n").alias("n")).join(grams.select("gram").distinct(), "gram", "left_semi"))


def rare_seeds(grams: DataFrame, counts: DataFrame, documents: int) -> DataFrame:
    """(item, gram): the seeds among ``grams(item, at, gram)``. The windows see the 3-grams of one item."""
    rare = max(RARE_LEAST, documents // RARE_SHARE)
    inside = W.partitionBy("item").orderBy("at")
    counted = (grams.join(counts, "gram", "left")
               .withColumn("least", F.min("n").over(inside.rowsBetween(0, WINDOW - 1)))
               .withColumn("least", F.max("least").over(inside.rowsBetween(1 - WINDOW, 0))))
    return counted.where((F.col("n") <= rare) | (F.col("n") <= NEAR_RAREST * F.col("least"))).select("item", "gram").distinct()


def bitmap(hashes: DataFrame, column: str) -> np.ndarray:
    """Bitmap (2 ** BITMAP_BITS bits) of a hash column's top bits; at most 2 ** (BITMAP_BITS - 6) rows
    reach the driver."""
    place = F.shiftrightunsigned(column, 64 - BITMAP_BITS)
    got = (hashes.select((place / 64).cast("int").alias("w"), F.expr(f"shiftleft(1L, cast({_sql(column)} as int))").alias("b"))
           .groupBy("w").agg(F.bit_or("b").alias("b")).collect())
    out = np.zeros(1 << (BITMAP_BITS - 6), np.uint64)
    for r in got:
        out[r.w] = np.int64(r.b).view(np.uint64)
    return out


def _sql(column: str) -> str:
    return f"shiftrightunsigned(`{column}`, {64 - BITMAP_BITS}) % 64"


def passes(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    place = h >> np.uint64(64 - BITMAP_BITS)
    return (bits[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1) == 1


def passages(docs: DataFrame, bits, margin: int, text: str, doc_id: str) -> DataFrame:
    """(doc_id, tie, start, grams, words): words around the clusters of seeds in every document.

    Seeds less than 2 * margin words apart share a passage; a passage reaches ``margin`` words to
    either side of its seeds. A cluster longer than LONGEST_PASSAGE words is cut; the parts overlap
    by twice the margin, so every item-sized stretch lies whole in one of them.
    """

    def rows(batches):
        for batch in batches:
            for part in tv.bounded_slices(batch, "text"):
                h, before = words(part.column("text"))
                g, at, _ = tv.word_ngrams(h, before, GRAM)
                hit = np.flatnonzero(passes(bits.value, g))
                if not len(hit):
                    continue
                pos, gram = at[hit], g[hit]
                doc = np.searchsorted(before, pos, side="right") - 1
                new = np.ones(len(pos), bool)
                new[1:] = (doc[1:] != doc[:-1]) | (np.diff(pos) >= 2 * margin)
                first = np.flatnonzero(new)
                last = np.append(first[1:], len(pos))
                out: dict[str, list] = {k: [] for k in ("row", "start", "grams", "words")}
                for a, b in zip(first, last):
                    d = doc[a]
                    lo, hi = max(before[d], pos[a] - margin), min(before[d + 1], pos[b - 1] + GRAM + margin)
                    for s in range(lo, max(lo + 1, hi - 2 * margin), LONGEST_PASSAGE):
                        e = min(hi, s + LONGEST_PASSAGE + 2 * margin)
                        own = np.unique(gram[a:b][(pos[a:b] >= s) & (pos[a:b] + GRAM <= e)]).view(np.int64)
                        if len(own):
                            out["row"].append(int(d))
                            out["start"].append(int(s - before[d]))
                            out["grams"].append(own.tolist())
                            out["words"].append(h[s:e].tobytes())
                take = pa.array(out["row"], pa.int64())
                yield pa.RecordBatch.from_pydict({
                    "doc_id": part.column("doc_id").take(take), "tie": part.column("tie").take(take),
                    "start": pa.array(out["start"], pa.int64()),
                    "grams": pa.array(out["grams"], pa.list_(pa.int64())),
                    "words": pa.array(out["words"], pa.binary())})

    return (docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("tie"), F.col(text).alias("text"))
            .mapInArrow(rows, f"doc_id {docs.schema[doc_id].dataType.simpleString()}, tie long, start long, "
                              "grams array<long>, words binary"))


def _best_end(item: np.ndarray, passage: np.ndarray) -> tuple[int, int, int]:
    """(score, words of the item, words of the passage before the best alignment's end)."""
    slope = np.arange(len(passage) + 1) * -GAP
    row = np.zeros(len(passage) + 1, np.int64)
    best = (0, 0, 0)
    for i, word in enumerate(item):
        step = np.zeros(len(passage) + 1, np.int64)
        np.maximum(row[:-1] + np.where(passage == word, MATCH, MISMATCH), row[1:] + GAP, out=step[1:])
        np.maximum(step, 0, out=step)
        row = np.maximum.accumulate(step + slope) - slope       # gaps along the passage
        j = int(row.argmax())
        if row[j] > best[0]:
            best = (int(row[j]), i + 1, j)
    return best


def align(item: np.ndarray, passage: np.ndarray) -> tuple[int, int, int]:
    """(score, first, end): the best local alignment and the passage words it covers."""
    score, i, j = _best_end(item, passage)
    if not score:
        return 0, 0, 0
    _, _, back = _best_end(item[:i][::-1], passage[:j][::-1])
    return score, j - back, j


def leaks(docs: DataFrame, items: DataFrame, min_score: float = MIN_SCORE, text: str = "text",
          doc_id: str = "doc_id") -> DataFrame:
    """Leaks: (doc_id, tie, item_id, score, first_word, end_word), the best alignment of each pair.

    ``tie`` is the hash of the document's text (it tells repeated doc_ids apart).
    """
    spark = docs.sparkSession
    known = written(item_words(items.select("item_id", "text")), "items")
    distinct = known.groupBy("item").agg(F.first("words").alias("words"))
    longest = (known.agg(F.max(F.octet_length("words"))).first()[0] or 0) // 8
    grams = written(item_grams(distinct), "item-grams")
    counts = gram_counts(docs, grams, text)
    seeds = written(rare_seeds(grams, counts, docs.count()), "seeds")
    shared_seeds = spark.sparkContext.broadcast(bitmap(seeds, "gram"))
    margin = longest + longest // 2 + GRAM
    found = written(passages(docs, shared_seeds, margin, text, doc_id), "passages")
    # equal passages (copies) are aligned once: they are told apart by the hash of their words
    found = found.withColumn("passage", F.xxhash64("words"))
    pairs = (found.select("passage", "grams").dropDuplicates(["passage"])
             .select("passage", F.explode("grams").alias("gram")).join(seeds, "gram")
             .select("passage", "item").distinct())
    texts = found.groupBy("passage").agg(F.first("words").alias("p_words"))

    def aligned(batches):
        for batch in batches:
            out = []
            for p, i in zip(batch.column("p_words").to_pylist(), batch.column("words").to_pylist()):
                item, passage = np.frombuffer(i, np.uint64), np.frombuffer(p, np.uint64)
                # an alignment matches no more item words than the passage holds
                enough = np.isin(item, passage).sum() / len(item) >= min_score
                score, first, end = align(item, passage) if enough else (0, 0, 0)
                out.append((score / (MATCH * len(item)), first, end))
            yield pa.RecordBatch.from_pydict({
                "passage": batch.column("passage"), "item": batch.column("item"),
                "score": pa.array([o[0] for o in out], pa.float64()),
                "first": pa.array([o[1] for o in out], pa.int64()), "end": pa.array([o[2] for o in out], pa.int64())})

    scored = (pairs.join(texts, "passage").join(distinct, "item").select("passage", "item", "p_words", "words")
              .mapInArrow(aligned, "passage long, item long, score double, first long, end long")
              .where(F.col("score") >= min_score))
    matched = written(scored.join(known.select("item", "item_id"), "item").drop("item"), "matched-passages")
    return (found.select("doc_id", "tie", "start", "passage").join(matched, "passage")
            .groupBy("doc_id", "tie", "item_id").agg(F.max(F.struct(
                F.col("score"), (-(F.col("start") + F.col("first"))).alias("first"),
                (F.col("start") + F.col("end")).alias("end"))).alias("best"))
            .select("doc_id", "tie", "item_id", "best.score", (-F.col("best.first")).alias("first_word"),
                    F.col("best.end").alias("end_word")))


def clean(docs: DataFrame, items: DataFrame, min_score: float = MIN_SCORE, text: str = "text",
          doc_id: str = "doc_id") -> DataFrame:
    """``docs`` without the documents that hold a leak.

    Rows that repeat a leaking document's doc_id and text go with it; another text under that doc_id stays, as do
    null and empty texts. An empty table of documents gives none, one of items leaves all.
    """
    tie, l_id, l_tie = (fresh(docs, c) for c in ("_tie", "_leak_id", "_leak_tie"))
    found = leaks(docs, items, min_score, text, doc_id).select(
        F.col("doc_id").alias(l_id), F.col("tie").alias(l_tie)).distinct()
    return docs.withColumn(tie, F.xxhash64(text)).join(
        found, F.col(doc_id).eqNullSafe(F.col(l_id)) & (F.col(tie) == F.col(l_tie)), "left_anti").drop(tie)
