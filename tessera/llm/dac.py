"""Token-id files as directly addressable codes: any token is read without decoding a block.

An id is split into chunks, lowest bits first (level widths 8, 8, 16 bits: all 32-bit ids). Level k
holds the k-th chunk of every id that is that long, as a plain array, plus a continuation bitmap
(one bit per entry: has the id more chunks?) and a rank directory (set bits before every block of
512). Token i: take chunk i of the first level; while its bit is set, its place in the next level is
the number of set bits before it - one directory entry and at most eight popcounts.

File format (below one folder, written by Spark's committer, so a lost executor leaves no half file):

* ``segments``: one row per segment of about ``SEGMENT_TOKENS`` ids (a document is never split):
  ``part, segment, start`` (ids before it in its part), ``n_tokens``, the document directory
  ``doc_ids, doc_starts`` and the ``levels``;
* ``parts``: ids before each part. Parts are ranges of doc_id, in ascending order.
"""
from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from tessera.llm import textvec as tv
from tessera.llm.tokens import encoder, tokenizer_path

WIDTHS = (8, 8, 16)
BLOCK_BITS = 512
SEGMENT_TOKENS = 1 << 18
_KINDS = {8: np.uint8, 16: np.uint16, 32: np.uint32}
_LEVEL = pa.struct([("width", pa.int32()), ("n", pa.int64()), ("chunks", pa.binary()),
                    ("bitmap", pa.binary()), ("ranks", pa.binary())])
_SEGMENT = pa.schema([("part", pa.int32()), ("segment", pa.int32()), ("start", pa.int64()),
                      ("n_tokens", pa.int64()), ("doc_ids", pa.list_(pa.int64())),
                      ("doc_starts", pa.list_(pa.int64())), ("levels", pa.list_(_LEVEL))])
SEGMENT_SCHEMA = ("part int, segment int, start long, n_tokens long, doc_ids array<long>, "
                  "doc_starts array<long>, levels array<struct<width int, n long, chunks binary, "
                  "bitmap binary, ranks binary>>")


def encode(ids: np.ndarray, widths: tuple[int, ...] = WIDTHS) -> list[dict]:
    """Levels of an id array (unsigned 32-bit)."""
    levels, rest = [], ids.astype(np.uint32)
    for k, width in enumerate(widths):
        chunks = (rest & np.uint32((1 << width) - 1)).astype(_KINDS[width])
        more = np.zeros(len(rest), bool) if k == len(widths) - 1 else (rest >> np.uint32(width)) > 0
        bits = np.packbits(more, bitorder="little")
        bitmap = np.zeros(-(-max(1, len(more)) // BLOCK_BITS) * (BLOCK_BITS // 8), np.uint8)
        bitmap[:len(bits)] = bits
        set_bits = np.bitwise_count(bitmap.view(np.uint64)).reshape(-1, BLOCK_BITS // 64).sum(1)
        ranks = np.concatenate([[0], np.cumsum(set_bits)])[:-1].astype(np.uint32)
        levels.append({"width": width, "n": len(rest), "chunks": chunks.tobytes(),
                       "bitmap": bitmap.tobytes(), "ranks": ranks.tobytes()})
        rest = rest[more] >> np.uint32(width) if width < 32 else rest[:0]
        if not len(rest):
            break
    return levels


def _open(level: dict):
    return (np.frombuffer(level["chunks"], _KINDS[level["width"]]),
            np.frombuffer(level["bitmap"], np.uint64), np.frombuffer(level["ranks"], np.uint32))


def access(levels: list[dict], at: np.ndarray) -> np.ndarray:
    """Ids at the positions ``at``, by chunk, bitmap and rank directory alone."""
    at = np.asarray(at, np.int64)
    out = np.zeros(len(at), np.uint32)
    alive, shift = np.arange(len(at)), 0
    for level in levels:
        chunks, words, ranks = _open(level)
        out[alive] |= chunks[at].astype(np.uint32) << np.uint32(shift)
        shift += level["width"]
        bit = (at & 63).astype(np.uint64)
        more = (words[at >> 6] >> bit) & np.uint64(1) == 1
        if not more.any():
            break
        alive, at, bit = alive[more], at[more], bit[more]
        word, block = at >> 6, at // BLOCK_BITS
        rank = ranks[block].astype(np.int64)
        for j in range(BLOCK_BITS // 64):
            w = block * (BLOCK_BITS // 64) + j
            rank += np.where(w < word, np.bitwise_count(words[w]), 0)
        at = rank + np.bitwise_count(words[word] & ((np.uint64(1) << bit) - np.uint64(1)))
    return out


def decode(levels: list[dict]) -> np.ndarray:
    """All ids of a segment in order (sequential reading)."""
    at, out, shift = None, None, 0
    for level in levels:
        chunks, words, _ = _open(level)
        if out is None:
            out, at = chunks.astype(np.uint32), np.arange(len(chunks))
        else:
            out[at] |= chunks.astype(np.uint32) << np.uint32(shift)
        shift += level["width"]
        more = np.unpackbits(words.view(np.uint8), count=level["n"], bitorder="little").astype(bool)
        at = at[more]
    return out


def segments(docs: DataFrame, tokenizer: str, end_id: int, parts: int | None = None) -> DataFrame:
    """Rows of the ``segments`` file for ``docs(doc_id, text)``.

    Documents are dealt into ranges of doc_id; a doc_id that many rows share is dealt further by a
    hash of the text (equal ids lie in the order of that hash, null ids come first). Null texts are
    empty: they hold the end id alone.
    """
    parts = parts or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
             .withColumn("tie", F.xxhash64("text"))
             .repartitionByRange(parts, "doc_id", "tie").sortWithinPartitions("doc_id", "tie")
             .select("doc_id", "text", F.spark_partition_id().alias("part")))

    def rows(batches):
        enc = encoder(tokenizer)
        part, number, before_all = 0, 0, 0
        ids, names, lengths, held = [], [], [], 0

        def segment():
            nonlocal number, before_all, held
            all_ids = np.concatenate(ids)
            starts = np.concatenate([[0], np.cumsum(np.concatenate(lengths))])[:-1]
            row = {"part": part, "segment": number, "start": before_all, "n_tokens": len(all_ids),
                   "doc_ids": [x for n in names for x in n], "doc_starts": starts.tolist(),
                   "levels": encode(all_ids)}
            number, before_all, held = number + 1, before_all + len(all_ids), 0
            ids.clear(), names.clear(), lengths.clear()
            return pa.RecordBatch.from_pylist([row], schema=_SEGMENT)

        for batch in batches:
            for some in tv.bounded_slices(batch, "text", SEGMENT_TOKENS * 4):
                part = some.column("part")[0].as_py()
                got, before = enc.encode(*tv.utf8(some.column("text")))
                ids.append(np.insert(got, before[1:], np.uint32(end_id)))
                names.append(some.column("doc_id").to_pylist())
                lengths.append(np.diff(before) + 1)
                held += len(ids[-1])
                if held >= SEGMENT_TOKENS:
                    yield segment()
        if held:
            yield segment()

    return dealt.mapInArrow(rows, SEGMENT_SCHEMA)


def write(docs: DataFrame, path: str, tokenizer: str | None = None, end_id: int = 2,
          parts: int | None = None) -> None:
    """Encode ``docs(doc_id, text)`` and write the token files below ``path``."""
    spark = docs.sparkSession
    segments(docs, tokenizer or tokenizer_path("word_bpe_49k.json"), end_id, parts).write.parquet(f"{path}/segments")
    sizes = spark.read.parquet(f"{path}/segments").groupBy("part").agg(F.sum("n_tokens").alias("n_tokens"))
    # one row per file part: the running sum over them is small whatever the corpus
    (sizes.withColumn("base", F.coalesce(F.sum("n_tokens").over(
        W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
     .coalesce(1).write.parquet(f"{path}/parts"))


def _segments(spark: SparkSession, path: str) -> DataFrame:
    # `parts` has one row per file part
    parts = spark.read.schema("part int, n_tokens long, base long").parquet(f"{path}/parts").select("part", "base")
    return spark.read.schema(SEGMENT_SCHEMA).parquet(f"{path}/segments").join(F.broadcast(parts), "part")


def read_documents(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32[, ids]) of every document, decoded from the files."""
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids binary" if with_ids else "")

    def rows(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                seg = batch.slice(k, 1).to_pylist()[0]
                raw = memoryview(decode(seg["levels"]).tobytes())
                starts = [*seg["doc_starts"], seg["n_tokens"]]
                cut = [raw[4 * a:4 * b] for a, b in zip(starts, starts[1:])]
                base = seg["base"] + seg["start"]
                out = {"doc_id": pa.array(seg["doc_ids"], pa.int64()),
                       "start": pa.array([base + s for s in starts[:-1]], pa.int64()),
                       "n_tokens": pa.array([len(c) // 4 for c in cut], pa.int64()),
                       "ids_crc32": pa.array([zlib.crc32(c) for c in cut], pa.int64())}
                if with_ids:
                    out["ids"] = pa.array([bytes(c) for c in cut], pa.binary())
                yield pa.RecordBatch.from_pydict(out)

    return _segments(spark, path).mapInArrow(rows, schema)


def tokens_at(spark: SparkSession, path: str, positions: DataFrame) -> DataFrame:
    """(position, token) for every distinct position of ``positions(position)`` that exists.

    Positions find their segment by an equi-join on position blocks (a segment covers a few), then
    each segment answers all its positions by random access. Null and out-of-range ones are left out.
    """
    known = _segments(spark, path)
    first = F.col("base") + F.col("start")
    places = known.select("part", "segment", first.alias("_first"), (first + F.col("n_tokens")).alias("_end")).select(
        "*", F.explode(F.sequence(F.floor(F.col("_first") / SEGMENT_TOKENS),
                                  F.floor((F.col("_end") - 1) / SEGMENT_TOKENS))).alias("_block"))
    asked = positions.select(F.col("position").cast("long").alias("position")).where("position >= 0").distinct()
    found = (asked.withColumn("_block", F.floor(F.col("position") / SEGMENT_TOKENS)).join(places, "_block")
             .where("position >= _first and position < _end").groupBy("part", "segment")
             .agg(F.collect_list(F.col("position") - F.col("_first")).alias("at")))   # at most a segment's size

    def rows(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                seg = batch.slice(k, 1).to_pylist()[0]
                got = access(seg["levels"], np.array(seg["at"], np.int64))
                yield pa.RecordBatch.from_pydict({
                    "position": pa.array([seg["base"] + seg["start"] + a for a in seg["at"]], pa.int64()),
                    "token": pa.array(got.astype(np.int64), pa.int64())})

    return (known.select("part", "segment", "base", "start", "levels").join(found, ["part", "segment"])
            .mapInArrow(rows, "position long, token long"))
