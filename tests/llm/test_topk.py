"""Exact top-k against brute force: ties, repeated and null ids, unusable vectors, widths, early stops."""
import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import topk


def brute(rows, k):
    """Multiset of (query_id, rank, vec_id, score)."""
    use = [(v, [math.floor(256 * float(np.float32(x))) for x in e]) for v, e in rows
           if e is not None and all(x is not None and math.isfinite(x) for x in e)]
    out = []
    for i, (v, q) in enumerate(use):
        if v is None or v % 5:
            continue
        best = sorted(((-sum(a * b for a, b in zip(q, x)), u is None, u or 0) for j, (u, x) in enumerate(use) if j != i))
        out += [(v, r + 1, None if none else u, -s) for r, (s, none, u) in enumerate(best[:k])]
    return Counter(out)


def run(spark, rows, k, **sizes):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("row", F.lit("clash"))
    return Counter(map(tuple, topk.top_k(df, F.col("vec_id") % 5 == 0, k).collect()))


@pytest.mark.parametrize("block, batch", [(4096, 512), (16, 7)])
def test_equals_brute_force(spark, monkeypatch, block, batch):
    monkeypatch.setattr(topk, "BLOCK", block)
    monkeypatch.setattr(topk, "QUERIES", batch)
    rng = random.Random(3)
    rows = [(i, [rng.gauss(0, 0.2) for _ in range(12)]) for i in range(150)]
    rows += [(200 + i, [1.0, 0.0, -0.5] * 4) for i in range(40)]            # ties and equal vectors
    rows += [(5, [0.5] * 12), (5, [0.5] * 12), (None, [0.9] * 12), (None, None), (700, None)]
    rows += [(701, [1.0, None] * 6), (702, [float("nan")] * 12), (703, [float("inf")] * 12)]
    rows += [(710, []), (715, [2.0] * 5), (720, [0.25] * 20), (725, [-3.0] * 12)]
    assert run(spark, rows, 5) == brute(rows, 5)


def test_fewer_rows_than_k_and_empty(spark):
    rows = [(0, [1.0, 2.0]), (1, [0.5, 0.5])]
    assert run(spark, rows, 5) == brute(rows, 5) == Counter({(0, 1, 1, 384 * 256): 1})
    assert run(spark, [(0, [1.0])], 5) == Counter()
    assert run(spark, [], 5) == Counter()


@pytest.mark.parametrize("skew", [0.0, 1.5])
def test_early_stop_is_exact(skew):
    """Clustered vectors with uneven dimensions stop early; the answers stay those of a full scan."""
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(8, 32))
    x = np.floor(60 * (centres[rng.integers(0, 8, 900)] + 0.2 * rng.normal(size=(900, 32)))
                 * np.exp(-skew * np.arange(32) / 4)).astype(np.int32)
    at, dim = np.nonzero(x)
    value = x[at, dim]
    order = np.lexsort((at, dim, value, -np.abs(value)))
    at, dim, value = at[order], dim[order], value[order]
    first = np.flatnonzero(np.concatenate([[True], (dim[1:] != dim[:-1]) | (value[1:] != value[:-1])]))
    block = {"x": x, "dims": dim[first], "impacts": value[first], "sizes": np.diff(np.append(first, len(at))),
             "postings": at, "order": np.arange(900)}
    q = x[:60]
    for query, best, score in topk.search_block(block, q, np.arange(60), 5):
        full = x.astype(np.int64) @ q[query].astype(np.int64)
        full[query] = -10 ** 15
        want = np.lexsort((np.arange(900), -full))[:5]
        assert best.tolist() == want.tolist() and score.tolist() == full[want].tolist()


@pytest.mark.parametrize("kind", ["float", "double"])
def test_components_of_any_finite_size(spark, monkeypatch, kind):
    """Components from 2 ** 22 to the largest float: exact integers, clipped to 64 bits."""
    monkeypatch.setattr(topk, "BLOCK", 16)
    monkeypatch.setattr(topk, "QUERIES", 7)
    rng = random.Random(9)
    f32 = lambda x: float(np.float32(x))
    rows = [(i, [f32(rng.gauss(0, 1)) for _ in range(6)]) for i in range(60)]
    rows += [(100 + i, [f32(rng.choice([-1, 1]) * rng.random() * 10 ** rng.choice([6, 7, 8, 9, 12])) for _ in range(6)]) for i in range(30)]
    rows += [(200 + i, [f32(rng.choice([1e30, 3e38, -1e20, 0.5])) for _ in range(6)]) for i in range(12)]
    rows += [(300, [f32(2 ** 23)] * 6), (301, [f32(-2 ** 31)] * 6), (305, []), (None, [1e7] * 6)]
    if kind == "double":
        rows += [(400, [1.7e308, 1.0]), (405, [-1e300, 0.25])]
    df = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>")
    got = Counter(map(tuple, topk.top_k(df, F.col("vec_id") % 5 == 0, 5).collect()))
    use = [(v, [math.floor(x * 256) if abs(x * 256) < math.inf else int(math.copysign(topk.MOST, x)) for x in e]) for v, e in rows]
    want = Counter()
    for i, (v, q) in enumerate(use):
        if v is not None and v % 5 == 0:
            clip = lambda s: max(-2 ** 63, min(2 ** 63 - 1, s))
            best = sorted((-clip(sum(a * b for a, b in zip(q, x))), u is None, u or 0) for j, (u, x) in enumerate(use) if j != i)
            want.update((v, r + 1, None if none else u, -s) for r, (s, none, u) in enumerate(best[:5]))
    assert got == want


def _sent(plan, below=False):
    """Bytes that the exchanges below the plan's Python step wrote."""
    name = plan.getClass().getSimpleName()
    if name == "AdaptiveSparkPlanExec":
        return _sent(plan.executedPlan(), below)
    if name.endswith("QueryStageExec"):
        return _sent(plan.plan(), below)
    below |= name == "MapInArrowExec"
    own = plan.metrics().apply("dataSize").value() if below and name == "ShuffleExchangeExec" else 0
    children = plan.children()
    return own + sum(_sent(children.apply(i), below) for i in range(children.size()))


def test_blocks_are_sent_once(spark, monkeypatch):
    """What meets the queries does not grow with the number of batches times that of blocks."""
    rng = np.random.default_rng(5)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rng.normal(size=(800, 16)))], "vec_id long, embedding array<float>")
    monkeypatch.setattr(topk, "BLOCK", 50)
    sent, got = [], []
    for batch in (160, 8):
        monkeypatch.setattr(topk, "QUERIES", batch)
        found = topk.top_k(df, F.col("vec_id") % 5 == 0, 3)
        got.append(Counter(map(tuple, found.collect())))
        sent.append(_sent(found._jdf.queryExecution().executedPlan()))
    assert got[0] == got[1] and sum(got[0].values()) == 160 * 3
    assert 0 < sent[1] < 2 * sent[0]


@pytest.mark.parametrize("span", [1 << 24, 200])
def test_spans_and_floors(spark, monkeypatch, span):
    """Many blocks in a task: ties across blocks go to the smaller id, nulls last; scores beyond 2 ** 24 and 2 ** 53 are exact."""
    monkeypatch.setattr(topk, "BLOCK", 10)
    monkeypatch.setattr(topk, "QUERIES", 9)
    monkeypatch.setattr(topk, "SPAN", span)
    monkeypatch.setattr(topk, "TASKS", 0)
    rng = random.Random(4)
    rows = [(rng.randint(0, 400), [rng.choice([-1.0, 0.5, 1.0]) for _ in range(4)]) for _ in range(300)]
    rows += [(None, [1.0] * 4) for _ in range(8)] + [(2 ** 63 - 1, [1.0] * 4), (0, [0.0] * 4)]
    rows += [(500 + i, [rng.gauss(0, 900) for _ in range(4)]) for i in range(40)]
    rows += [(600 + i, [float(rng.randint(-10 ** 5, 10 ** 5)) for _ in range(4)]) for i in range(40)]
    assert run(spark, rows, 5) == brute(rows, 5)


def test_stops_that_save_work_are_exact():
    """Energy in a few of many dimensions: bounds are worth trying there, with and without a floor from other blocks."""
    rng = np.random.default_rng(2)
    x = np.zeros((900, 400), np.int32)
    x[:, :7] = rng.integers(1900, 2000, (900, 7)) * rng.choice([-1, 1], (900, 7))
    x[:, 7:] = rng.integers(-2, 3, (900, 393))
    at, dim = np.nonzero(x)
    value = x[at, dim]
    order = np.lexsort((at, dim, value, -np.abs(value)))
    at, dim, value = at[order], dim[order], value[order]
    first = np.flatnonzero(np.concatenate([[True], (dim[1:] != dim[:-1]) | (value[1:] != value[:-1])]))
    block = {"x": x, "dims": dim[first], "impacts": value[first], "sizes": np.diff(np.append(first, len(at))),
             "postings": at, "order": np.arange(900)[::-1]}
    q, own = x[:700], np.where(np.arange(700) % 2, np.arange(700), -1)
    full = q.astype(np.int64) @ x.T.astype(np.int64)
    full[own >= 0, own[own >= 0]] = -10 ** 15
    for least in (np.full(700, topk.NONE), np.sort(full, 1)[:, -2]):
        query, best, score = topk.block_best(block, q, own, 2, least)
        assert block["stops"]
        for j in range(700):
            want = np.lexsort((block["order"], -full[j]))[:2]
            want = want[full[j][want] >= least[j]]
            assert best[query == j].tolist() == want.tolist() and score[query == j].tolist() == full[j][want].tolist()
