"""Best-fit packing of tokenised documents into sequences, planned on a length histogram.

1. Tokenise: one row per piece (place, length, crc32 of its ids), written to the shared folder.
2. Plan: best-fit decreasing over *counts of lengths*, not over documents. The histogram has at
   most ``capacity`` rows whatever the corpus size, and so has the driver's work: equal open
   sequences are kept as ranges, and one step fills a whole range. The plan is a list of runs "items
   [first, last) of length l take these slots", its size depends on ``capacity`` alone.
3. Place: a piece's rank within its length (salted, see ``common.ranked``) is joined with the run
   that covers it; that gives sequence and offset. No group of documents is ever gathered.
"""
from __future__ import annotations

import zlib
from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tessera.llm import textvec as tv
from tessera.llm.common import ranked, rows, written
from tessera.llm.tokens import encoder, tokenizer_path

PIECES_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long, spread long"


def tokenised_pieces(docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 0,
                     with_ids: bool = False) -> DataFrame:
    """Pieces of ``docs(doc_id, text)``: every document's ids, then ``end_id``, cut to ``capacity``.

    Only documents longer than ``capacity`` are cut; all their pieces are full but the first.
    A null text counts as empty (one piece holding ``end_id``); a null doc_id is kept; repeated
    rows are separate documents. ``spread`` numbers the rows of a task (for ranking, see
    ``common.ranked``). With ``with_ids`` a piece also carries its ids (binary, uint32).
    """
    schema = PIECES_SCHEMA + (", ids binary" if with_ids else "")

    def pieces(batches):
        from pyspark import TaskContext
        enc = encoder(tokenizer)
        number = TaskContext.get().partitionId() << 40
        end = np.array([end_id], np.uint32)
        for batch in batches:
            for part in tv.bounded_slices(batch, "text"):
                ids, before = enc.encode(*tv.utf8(part.column("text")))
                out: dict[str, list] = {k: [] for k in ("doc", "piece", "start", "length", "crc", "ids")}
                for i in range(part.num_rows):
                    own = np.concatenate([ids[before[i]:before[i + 1]], end])
                    first = len(own) % capacity or min(len(own), capacity)
                    cuts = [0, *range(first, len(own) + 1, capacity)]
                    for k in range(len(cuts) - 1):
                        raw = own[cuts[k]:cuts[k + 1]].tobytes()
                        out["doc"].append(i)
                        out["piece"].append(k)
                        out["start"].append(cuts[k])
                        out["length"].append(cuts[k + 1] - cuts[k])
                        out["crc"].append(zlib.crc32(raw))
                        out["ids"].append(raw if with_ids else None)
                n = len(out["doc"])
                columns = {
                    "doc_id": part.column("doc_id").cast(pa.int64()).take(pa.array(out["doc"], pa.int64())),
                    "piece": pa.array(out["piece"], pa.int32()),
                    "start": pa.array(out["start"], pa.int64()),
                    "length": pa.array(out["length"], pa.int64()),
                    "ids_crc32": pa.array(out["crc"], pa.int64()),
                    "spread": pa.array(np.arange(number, number + n), pa.int64()),
                }
                if with_ids:
                    columns["ids"] = pa.array(out["ids"], pa.binary())
                number += n
                yield pa.RecordBatch.from_pydict(columns)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(pieces, schema)


def plan_best_fit(counts: dict[int, int], capacity: int) -> tuple[list[tuple], int]:
    """Best-fit decreasing over a length histogram.

    Returns (runs, sequences). A run ``(length, first, last, per, sequence, offset)`` places the
    items ranked [first, last) within ``length``: item r goes to sequence
    ``sequence + (r - first) // per`` at ``offset + ((r - first) % per) * length``.
    """
    runs, sequences = [], 0
    spare: list[int] = []                           # sorted remaining sizes that are open
    open_at: dict[int, list[tuple[int, int]]] = {}  # remaining size -> ranges (first sequence, n)

    def add(room: int, first: int, n: int) -> None:
        if room and n:
            if room not in open_at:
                insort(spare, room)
                open_at[room] = []
            open_at[room].append((first, n))

    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        if not 0 < length <= capacity:
            raise ValueError(f"a piece of length {length} does not fit into {capacity}")

        def fill(first: int, n: int, room: int) -> None:
            """Put as many items as fit (tightest first) into n equal sequences with ``room`` left."""
            nonlocal left, rank
            per = room // length
            full, rest = divmod(left, per) if left < n * per else (n, 0)
            if full:
                runs.append((length, rank, rank + full * per, per, first, capacity - room))
                add(room - per * length, first, full)
            if rest:
                runs.append((length, rank + full * per, rank + full * per + rest, rest,
                             first + full, capacity - room))
                add(room - rest * length, first + full, 1)
            add(room, first + full + (rest > 0), n - full - (rest > 0))
            left -= full * per + rest
            rank += full * per + rest

        while left:
            k = bisect_left(spare, length)
            if k < len(spare):
                room = spare[k]
                first, n = open_at[room].pop()
                if not open_at[room]:
                    del open_at[room], spare[k]
                fill(first, n, room)
            else:
                per = capacity // length
                n = -(-left // per)
                first, sequences = sequences, sequences + n
                fill(first, n, capacity)
    return runs, sequences


def place(pieces: DataFrame, capacity: int = 2048, length: str = "length", spread: str = "spread",
          order: tuple[str, ...] = ("doc_id", "piece", "ids_crc32")) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to stored pieces (any table with a length column)."""
    spark = pieces.sparkSession
    # At most `capacity` rows: the histogram's size does not depend on the corpus.
    counts = {r[0]: r[1] for r in pieces.groupBy(length).count().collect()}
    runs, _ = plan_best_fit(counts, capacity)
    fields = "_l long, _from long, _to long, _per long, _seq long, _off long"
    plan = rows(spark, [dict(zip(("_l", "_from", "_to", "_per", "_seq", "_off"), r)) for r in runs], fields)
    numbered = ranked(pieces, [length], list(order), max(counts.values(), default=0), spread, "_rank")
    item = F.col("_rank") - F.col("_from")
    # The plan's size depends on `capacity` alone (a few runs per length), so it may be broadcast.
    return (numbered.join(F.broadcast(plan), (F.col(length) == F.col("_l"))
                          & (F.col("_rank") >= F.col("_from")) & (F.col("_rank") < F.col("_to")))
            .withColumn("sequence_id", F.col("_seq") + F.floor(item / F.col("_per")).cast("long"))
            .withColumn("offset", F.col("_off") + (item % F.col("_per")) * F.col(length))
            .drop("_rank", "_l", "_from", "_to", "_per", "_seq", "_off"))


def pack(docs: DataFrame, tokenizer: str | None = None, capacity: int = 2048, end_id: int = 0,
         with_ids: bool = False) -> DataFrame:
    """Pack ``docs(doc_id, text)``: one row per piece with its sequence and offset.

    An empty table gives no rows. Other columns of ``docs`` are ignored.
    """
    pieces = written(tokenised_pieces(docs, tokenizer or tokenizer_path("byte_bpe_50k.json"),
                                      capacity, end_id, with_ids), "pieces")
    return place(pieces, capacity).drop("spread")


def sequences(placed: DataFrame) -> DataFrame:
    """The packed sequences themselves: (sequence_id, n_tokens, ids binary) from ``pack(with_ids=True)``.

    A sequence holds at most ``capacity`` ids, so its pieces are a bounded group.
    """
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return placed.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), parts.alias("parts")).select(
        "sequence_id", "n_tokens",
        F.unhex(F.array_join(F.transform("parts", lambda p: F.hex(p["ids"])), "")).alias("ids"))
