"""Consistent-hash ring with virtual nodes and bounded loads, as DataFrame operations.

Every shard has ``vnodes`` points on a ring of 64-bit hashes; a key belongs to the first point at
or after its own hash. A shard takes at most its quota. Keys beyond it overflow: they continue
clockwise to the next point whose shard has room. Everything is decided on *counts per arc*: the
ring has ``shards * vnodes`` arcs, whatever the corpus size, so the plan is small and bounded, and a
key finds its shard by its rank within its arc.

Which keys overflow: a shard first takes the keys of its own arcs (arc by arc in ring order, by
rank); only what exceeds its quota moves on. So no more keys move than the quotas force, and with
``load`` above 1 the usual trade of balance against movement applies.
"""
from __future__ import annotations

import json
from bisect import bisect_left

from pyspark.sql import Column, DataFrame, functions as F

from tessera.llm.common import fresh, ranked, rows, written


def ring(spark, shards: int, vnodes: int) -> list[tuple[int, int]]:
    """The ring's points in order: (hash of "shard:vnode", shard). Bounded: shards * vnodes rows."""
    points = spark.range(shards * vnodes).select(
        (F.col("id") % shards).cast("int").alias("shard"),
        F.xxhash64(F.concat_ws(":", F.col("id") % shards, F.floor(F.col("id") / shards))).alias("point"))
    return sorted((r.point, r.shard) for r in points.collect())


def _literal(values: list, kind: str) -> Column:
    """A constant array (folded once by the optimizer)."""
    return F.from_json(F.lit(json.dumps(values)), kind)


def arc_of(key: Column, points: list[int]) -> Column:
    """Number of the arc (the first point at or after the key's hash; past the last, the first).

    Written as a bounded search: the top bits of the hash pick a short sorted slice of the points.
    """
    slots = 1 << max(1, (len(points) - 1).bit_length())
    width = (1 << 64) // slots
    low = [-(1 << 63) + i * width for i in range(slots)]
    cut = [bisect_left(points, x) for x in low] + [len(points)]
    near = _literal([points[cut[i]:cut[i + 1]] for i in range(slots)], "array<array<bigint>>")
    before = _literal(cut[:-1], "array<int>")
    slot = (F.shiftrightunsigned(key, 64 - (slots.bit_length() - 1)) + slots // 2) % slots
    slot = slot.cast("int")
    passed = F.size(F.filter(F.element_at(near, slot + 1), lambda p: p < key))
    return ((F.element_at(before, slot + 1) + passed) % len(points)).cast("int")


def quotas(total: int, shards: int, load: float = 1.0) -> list[int]:
    """Most keys per shard; with ``load`` 1 they add up to ``total`` and differ by at most one."""
    if load <= 1.0:
        return [total // shards + (s < total % shards) for s in range(shards)]
    return [-int(-load * total // shards)] * shards


def plan_ring(counts: list[int], owner: list[int], quota: list[int]) -> list[tuple]:
    """Runs ``(arc, first, last, shard, slot)``: keys ranked [first, last) of an arc go to a shard,
    where they take the slots from ``slot`` on. Own arcs first, then the overflow, clockwise."""
    room, slot = list(quota), [0] * len(quota)
    runs, kept = [], []
    n = len(counts)

    def take(arc: int, first: int, shard: int, want: int) -> int:
        got = min(want, room[shard])
        if got:
            runs.append((arc, first, first + got, shard, slot[shard]))
            room[shard] -= got
            slot[shard] += got
        return got

    for arc in range(n):
        kept.append(take(arc, 0, owner[arc], counts[arc]))
    for arc in range(n):
        done, at = kept[arc], arc
        while done < counts[arc]:
            at = (at + 1) % n
            done += take(arc, done, owner[at], counts[arc] - done)
    return runs


def shard(docs: DataFrame, key: str = "doc_id", shards: int = 40, vnodes: int = 64,
          load: float = 1.0, order: tuple[str, ...] = ()) -> DataFrame:
    """Add ``shard`` and ``slot`` (gapless from 0 within a shard) to every row of ``docs``.

    Keys are hashed by value; null keys share one point of the ring. Repeated keys and repeated
    rows are placed row by row, and a hot arc is ranked in salted groups. ``order`` fixes the rank
    of the rows of an arc. ``load`` is the allowed load over the mean (1: counts at most one apart).
    An empty table gives no rows. Existing columns called ``shard`` or ``slot`` are replaced.
    """
    spark = docs.sparkSession
    points = ring(spark, shards, vnodes)
    owner = [s for _, s in points]
    arc, spread, place = (fresh(docs, c) for c in ("_arc", "_spread", "_rank"))
    base = docs.drop("shard", "slot")
    stored = written(base.withColumn(arc, arc_of(F.xxhash64(F.col(key)), [p for p, _ in points]))
                     .withColumn(spread, F.monotonically_increasing_id()), "arcs")
    # At most shards * vnodes rows.
    found = {r[0]: r[1] for r in stored.groupBy(arc).count().collect()}
    counts = [found.get(i, 0) for i in range(len(points))]
    runs = plan_ring(counts, owner, quotas(sum(counts), shards, load))
    names = [*(fresh(docs, c) for c in ("_a", "_from", "_to", "_slot")), "shard"]
    a, lo, hi, slot, _ = names
    plan = rows(spark, [dict(zip(names, (r[0], r[1], r[2], r[4], r[3]))) for r in runs],
                f"`{a}` int, `{lo}` long, `{hi}` long, `{slot}` long, shard int")
    placed = ranked(stored, [arc], list(order) or [spread], max(counts, default=0), spread, place)
    return (placed.join(F.broadcast(plan), (F.col(arc) == F.col(a))
                        & (F.col(place) >= F.col(lo)) & (F.col(place) < F.col(hi)))
            .withColumn("slot", F.col(slot) + F.col(place) - F.col(lo))
            .drop(arc, spread, a, lo, hi, place, slot))
