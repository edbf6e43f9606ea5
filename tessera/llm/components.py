"""Connected components of a link table, by large-star / small-star rounds.

Every round replaces a node's links by links to its smallest neighbour, first for larger, then for
smaller neighbours, until nothing changes (a logarithmic number of rounds in practice). A round is
two aggregations and two joins on the node; each is written to the shared folder, so a lost executor
costs one round at most and plans stay short. Nothing is collected but a pair of sums per round.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tessera.llm.common import written


def _both(links: DataFrame) -> DataFrame:
    return links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _star(links: DataFrame, large: bool) -> DataFrame:
    """Links to the smallest neighbour: of the larger neighbours (large) or the smaller ones."""
    near = _both(links) if large else links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = near.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    joined = near.join(least, "a")
    if large:
        moved = joined.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        moved = joined.select("b", "m").unionByName(least.select(F.col("a").alias("b"), "m")).select(
            F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.where(F.col("a") != F.col("b")).distinct()


def components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of ``links(a, b)``: the smallest node it is connected with.

    Nodes are integers. Self-links and repeated links are fine; null ends are left out.
    """
    now = written(links.where("a is not null and b is not null and a <> b").select("a", "b").distinct(), "links")
    seen = None
    for _ in range(most_rounds):
        now = written(_star(_star(now, True), False), "links")
        # stars do not change any more once every link is (node, smallest node of its component)
        state = now.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
        if state == seen:
            break
        seen = state
    else:
        raise RuntimeError("components did not settle")
    stars = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return stars.unionByName(stars.select(F.col("component").alias("node"), "component").distinct())
