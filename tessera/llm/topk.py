"""Exact top-k inner products over an impact-ordered, score-at-a-time index.

Vectors are turned into integers (``floor(256 * x)``): the quantised impacts. The index is dealt into
blocks of about ``BLOCK`` vectors. A block holds, for every (dimension, impact), the positions of its
vectors with that impact - a posting segment - and all segments lie in descending order of the
impact's size, so accumulators get the largest contributions first.

A batch of queries walks a block's segments in that order, a run of segments at a time (a product of the
queries with the run's postings). Between runs it bounds what is left for every vector: the rest of the
score is at most ``|q| * |rest of x|`` (Cauchy-Schwarz over the unread components) and at most
``sum |q| * next impact``. A query stops only when the vectors that may still be among its k best are
proven to be few; exactly those are rescored from the block's integer vectors. A query that gets no proof
reads all segments. So results are exact. A few queries of the first batch try the bounds at all points; the
others do at the point that saves the most work, or read on where trying costs more than it saves.

Every block answers every query batch. Blocks are dealt to spans of about ``SPAN`` components, one task each:
the span's blocks are opened once and held, and the query batches stream past them, each with its k-th best
score so far as a floor for the next block. So a block is moved once and a query once for each span; a
span's k best are merged with the others'.

Vectors with a component so large that 64-bit sums could overflow (``WIDE``) are no part of the segments.
They stand beside them as whole numbers of any size, and every score that involves one is an exact Python
integer. A score beyond 64 bits is reported as the nearest 64-bit integer.
"""
from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
from pyspark.sql import DataFrame, Window as W, functions as F

from tessera.llm.common import written

SCALE = 256
MOST = 1.7976931348623157e308
BLOCK = 4096                # vectors of a block
VALUES = 1 << 20            # components of a block, about (fewer vectors where they are wide)
QUERIES = 2048              # queries of a batch
GROUP = 16 << 20            # bytes of a row group of stored blocks
SPAN = 1 << 24              # components of the blocks that a task holds, about
TASKS = 3                   # spans for each core, at least (if there are as many blocks)
TILE = 512                  # queries that walk a block at once
SAMPLE = 16                 # queries that try the bounds first
BOUND = 80                  # work of trying bounds and rescoring, as that of reading so many dimensions
NONE = -2 ** 63             # score below all others
WIDE = 2 ** 31              # largest component times width from which a vector is scored with unbounded integers
CHECKS = (0.6, 0.8, 0.9, 0.95, 0.98)    # shares of a block's energy after which bounds are tried


def impacts(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(row, vec_id, x, wide): integer vectors as doubles (exact), written once; ``row`` numbers the rows (repeats
    included), ``wide`` says whether products of the vector may need more than 64 bits.

    Vectors that are null, or hold a null, NaN or infinite component, are left out.
    """
    x = F.col(embedding)
    finite = x.isNotNull() & ~F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    # doubles of 2 ** 52 and more are whole; the clamp keeps the product of the largest doubles finite
    scaled = lambda v: F.greatest(F.lit(-MOST), F.least(F.lit(MOST), v.cast("double") * SCALE))
    ints = F.transform(F.transform(x, scaled), lambda v: F.when(
        F.abs(v) < 2.0 ** 52, F.floor(v).cast("double")).otherwise(v))
    top = F.array_max(F.transform("x", lambda v: F.abs(v)))
    return written(vectors.where(finite).select(
        F.monotonically_increasing_id().alias("row"), F.col(vec_id).cast("long").alias("vec_id"), ints.alias("x"))
        .withColumn("wide", F.coalesce(top * F.size("x") >= WIDE, F.lit(False))), "impacts")


def _matrix(column, kind=np.int32) -> np.ndarray:
    """Rows of integers; shorter vectors are filled with zeros."""
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    size = np.diff(lists.offsets.to_numpy())
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    width = int(size.max()) if len(size) else 0
    out = np.zeros((len(size), width), kind)
    out[np.repeat(np.arange(len(size)), size), np.concatenate([np.arange(s) for s in size] or [size])] = flat
    return out


def _narrow(values: np.ndarray) -> bytes:
    """Whole numbers in 1, 2, 4 or 8 bytes each, as the largest needs."""
    top = max(int(values.max(initial=0)), -int(values.min(initial=0)) - 1)
    return values.astype(next(k for k in ("<i1", "<i2", "<i4", "<i8") if top <= np.iinfo(k).max)).tobytes()


def _numbers(raw: bytes, count: int) -> np.ndarray:
    return np.frombuffer(raw, f"<i{len(raw) // count}") if count else np.zeros(0, np.int8)


def _parts(table: pa.Table) -> tuple[pa.Table, dict]:
    """Rows for the index, and the columns that hold the wide ones."""
    wide = table.column("wide").combine_chunks()
    apart = table.filter(wide)
    x = _matrix(apart.column("x"), np.float64)
    return table.filter(pa.compute.invert(wide)), {
        "w_width": pa.array([x.shape[1]], pa.int32()), "w_ids": pa.array([apart.column("vec_id").to_pylist()], pa.list_(pa.int64())),
        "w_rows": pa.array([apart.column("row").to_numpy().astype(np.int64).tobytes()], pa.binary()),
        "w": pa.array([x.tobytes()], pa.binary())}


WIDE_SCHEMA = "w_width int, w_ids array<long>, w_rows binary, w binary"
INDEX_SCHEMA = ("block int, n int, width int, rows binary, vec_ids array<long>, segments int, dims binary, "
                "impacts binary, sizes binary, postings binary, vectors binary, " + WIDE_SCHEMA)


def build_index(ints: DataFrame, blocks: int) -> DataFrame:
    """One row per block: its posting segments in descending order of impact, and its vectors."""

    def index(table: pa.Table) -> pa.Table:
        block = table.column("block").slice(0, 1)
        table, apart = _parts(table)
        x = _matrix(table.column("x"))
        at, dim = np.nonzero(x)
        value = x[at, dim]
        order = np.lexsort((at, dim, value, -np.abs(value.astype(np.int64))))
        at, dim, value = at[order], dim[order], value[order]
        edge = np.concatenate([[True], (dim[1:] != dim[:-1]) | (value[1:] != value[:-1])]) if len(at) else np.zeros(0, bool)
        first = np.flatnonzero(edge)
        return pa.table({
            "block": block, "n": pa.array([len(x)], pa.int32()),
            "width": pa.array([x.shape[1]], pa.int32()),
            "rows": pa.array([table.column("row").to_numpy().astype(np.int64).tobytes()], pa.binary()),
            "vec_ids": pa.array([table.column("vec_id").to_pylist()], pa.list_(pa.int64())),
            "segments": pa.array([len(first)], pa.int32()),
            "dims": pa.array([_narrow(dim[first])], pa.binary()),
            "impacts": pa.array([_narrow(value[first])], pa.binary()),
            "sizes": pa.array([_narrow(np.diff(np.append(first, len(at))))], pa.binary()),
            "postings": pa.array([_narrow(at)], pa.binary()),
            "vectors": pa.array([_narrow(x)], pa.binary()), **apart})

    dealt = ints.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int"))
    return dealt.groupBy("block").applyInArrow(index, INDEX_SCHEMA)


def query_batches(queries: DataFrame, batches: int) -> DataFrame:
    """One row per batch of ``queries(row, vec_id, x)``."""
    def batch(table: pa.Table) -> pa.Table:
        number = table.column("batch").slice(0, 1)
        table, apart = _parts(table)
        x = _matrix(table.column("x"))
        return pa.table({
            "batch": number, "q_width": pa.array([x.shape[1]], pa.int32()),
            "q_rows": pa.array([table.column("row").to_numpy().astype(np.int64).tobytes()], pa.binary()),
            "q_ids": pa.array([table.column("vec_id").to_pylist()], pa.list_(pa.int64())),
            "q": pa.array([_narrow(x)], pa.binary()), **{f"q_{c}": v for c, v in apart.items()}})

    dealt = queries.withColumn("batch", F.pmod(F.xxhash64("row"), F.lit(batches)).cast("int"))
    return dealt.groupBy("batch").applyInArrow(
        batch, "batch int, q_width int, q_rows binary, q_ids array<long>, q binary, "
               "q_w_width int, q_w_ids array<long>, q_w_rows binary, q_w binary")


def _wide_best(queries: tuple, candidates: tuple, k: int):
    """(query row, query id, row, vec_id, score) of each query's k best candidates, by unbounded integers.

    ``queries`` and ``candidates`` are (rows, ids, vectors)."""
    (q_rows, q_ids, q), (rows, ids, x) = queries, candidates
    if not len(q_rows) or not len(rows):
        return
    width = min(q.shape[1], x.shape[1])
    whole = np.frompyfunc(int, 1, 1)
    x = whole(x[:, :width]) if width else np.zeros((len(rows), 0), object)
    for row, vec_id, v in zip(q_rows.tolist(), q_ids, whole(q[:, :width]) if width else np.zeros((len(q_rows), 0), object)):
        score = (x * v).sum(1).tolist() if width else [0] * len(rows)
        score = [max(-2 ** 63, min(2 ** 63 - 1, s)) for s in score]
        best = heapq.nsmallest(k, ((-s, i is None, i or 0, r) for s, i, r in zip(score, ids, rows.tolist()) if r != row))
        for s, none, i, r in best:
            yield row, vec_id, r, None if none else i, -s


def _runs(block: dict, kind, stops: list[int]):
    """(components of a run of segments as rows of the block, next impact, stop) of the runs that end at
    ``stops``, in descending order of impact; the last one has no next impact."""
    n, d = block["x"].shape
    ends = np.concatenate([[0], np.cumsum(block["sizes"], dtype=np.int64)])
    total = len(block["dims"])
    for lo, hi in zip([0, *stops], [*stops, total]):
        part = np.zeros((n, d), kind)
        size = block["sizes"][lo:hi]
        part[block["postings"][ends[lo]:ends[hi]], np.repeat(block["dims"][lo:hi], size)] = np.repeat(
            block["impacts"][lo:hi], size)
        yield part, (abs(int(block["impacts"][hi])) if hi < total else None), hi


def _floor(score: np.ndarray, k: int) -> np.ndarray:
    """For each row a value that k of its scores reach (NONE in rows of fewer): the k-th best of the maxima of parts."""
    m, n = score.shape
    if n < k:
        return np.full(m, NONE)
    step = max(1, min(64, n // (8 * k)))
    whole = n // step * step
    tops = score[:, :whole].reshape(m, whole // step, step).max(2)
    low = np.floor(np.partition(tops, tops.shape[1] - k, axis=1)[:, -k])
    return np.where(low > NONE / 2, low, NONE).astype(np.int64)


def _first(query, score, order, k: int) -> np.ndarray:
    """Places of each query's k first rows by (score descending, order), sorted by query."""
    at = np.lexsort((order, -score, query))
    edge = np.ones(len(at), bool)
    edge[1:] = query[at][1:] != query[at][:-1]
    begin = np.maximum.accumulate(np.where(edge, np.arange(len(at)), 0))
    return at[np.arange(len(at)) - begin < k]


def _walk(block: dict, q: np.ndarray, own: np.ndarray, k: int, least: np.ndarray, runs: list, kind):
    """(query, position, score) arrays of the k best that reach ``least``, and after which of ``runs`` how many queries settled."""
    x, order = block["x"], block["order"]
    n, d = x.shape
    width = min(d, q.shape[1])
    qs = np.zeros((len(q), d), np.int64)
    qs[:, :width] = q[:, :width]
    active, acc, now = np.arange(len(q)), None, qs.astype(kind)
    norm, total = np.sqrt((qs.astype(np.float64) ** 2).sum(1)), np.abs(qs).astype(np.float64).sum(1)
    none = np.array(NONE, np.int64).astype(kind)
    found, settled, read = [], {stop: 0 for _, after, stop in runs if after is not None}, None

    def take(queries: np.ndarray, rows: np.ndarray, at: np.ndarray, score: np.ndarray) -> None:
        best = _first(rows, score, order[at], k)
        found.append((queries[rows[best]], at[best], score[best]))

    for part, after, stop in runs:
        used = np.flatnonzero(part.any(0))          # a run may lie in few dimensions
        run = now @ part.T if len(used) == d else now[:, used] @ part[:, used].T
        acc = run if acc is None else np.add(acc, run, out=acc)
        if after is None:
            break
        read = part if read is None else read + part
        rest = np.sqrt(((x - read.astype(np.float64)) ** 2).sum(1))
        wide = np.float64 if kind == np.int64 else kind
        # the slack covers the rounding of the bound and of its sum with the score
        bound = np.multiply.outer(norm[active].astype(wide), rest.astype(wide) * wide(1 + 1e-4))
        np.minimum(bound, (after * total[active]).astype(wide)[:, None] * wide(1 + 1e-4), out=bound)
        bound += wide(2)
        mine = np.flatnonzero(own[active] >= 0)
        kth = least[active].astype(np.float64)
        if n > k and (least[active] == NONE).any():
            low = np.subtract(acc, bound, dtype=wide)
            low[mine, own[active][mine]] = -np.inf
            kth = np.maximum(kth, _floor(low, k))
        bound += acc
        possible = bound >= (kth - 1e-6 * np.abs(kth) - 1e-6).astype(wide)[:, None]
        possible[mine, own[active][mine]] = False
        few = possible.sum(1) <= max(4 * k, n // 128)
        if few.any():
            settled[stop] = int(few.sum())
            some = np.flatnonzero(few)
            for lo in range(0, len(some), 128):
                rows, at = np.nonzero(possible[some[lo:lo + 128]])
                queries = active[some[lo:lo + 128]]
                take(queries, rows, at, (x[at].astype(np.int64) * qs[queries[rows]]).sum(1))
            active, acc, now = active[~few], np.ascontiguousarray(acc[~few]), now[~few]
            if not len(active):
                break
    if len(active) and acc is not None:         # no proof: the accumulators are the scores
        mine = np.flatnonzero(own[active] >= 0)
        acc[mine, own[active][mine]] = none
        floor = least[active]
        fresh = np.flatnonzero(floor == NONE)
        if len(fresh):
            floor[fresh] = _floor(acc if len(fresh) == len(active) else acc[fresh], k)
        able = acc >= floor.astype(kind)[:, None]
        able[mine, own[active][mine]] = False
        for lo in range(0, len(active), 128):
            rows, at = np.divmod(np.flatnonzero(able[lo:lo + 128]), n)
            count = np.bincount(rows, minlength=len(able[lo:lo + 128]))
            many = count > max(64, 8 * k)       # ties, mostly: one query at a time
            for j in np.flatnonzero(many) + lo:
                tied = np.flatnonzero(able[j])
                take(active[j:j + 1], np.zeros(len(tied), np.int64), tied, acc[j, tied].astype(np.int64))
            if many.any():
                rows, at = rows[~many[rows]], at[~many[rows]]
            take(active[lo:lo + 128], rows, at, acc[lo + rows, at].astype(np.int64))
    query, at, score = (np.concatenate([f[c] for f in found]) if found else np.zeros(0, np.int64) for c in range(3))
    keep = score >= least[query]
    return query[keep], at[keep], score[keep], settled


def _paying(dims: np.ndarray, settled: dict[int, int], tried: int) -> list[int]:
    """The point after which bounds save the most work, if one saves any; work is counted in dimensions read."""
    best, stops, share = len(np.unique(dims)) + 16, [], 0.0
    for stop, n in settled.items():
        share += n / tried
        cost = len(np.unique(dims[:stop])) + BOUND + (1 - share) * (len(np.unique(dims[stop:])) + 16)
        if cost < best:
            best, stops = cost, [stop]
    return stops


def block_best(block: dict, q: np.ndarray, own: np.ndarray, k: int, least: np.ndarray):
    """(query, position, score) arrays: of each query's k best vectors of a block, own row left out, those
    that reach ``least`` (NONE: all); exact.

    ``block``: x (vectors), dims, impacts, sizes, postings. ``own``: position of the query's own
    row in the block, or -1. Ties go to the position that sorts first by ``block["order"]``. The block keeps
    after which segments bounds are tried (``block["stops"]``): where they saved work on the first queries."""
    x = block["x"]
    if not len(x) or not len(q):
        return tuple(np.zeros(0, np.int64) for _ in range(3))
    if not x.shape[1] or not len(block["dims"]):        # all products are zero
        score = np.zeros((len(q), len(x)), np.int64)
        score[own >= 0, own[own >= 0]] = NONE
        first = np.argsort(block["order"], kind="stable")[:k + 1]
        rows, at = np.repeat(np.arange(len(q)), len(first)), np.tile(first, len(q))
        score = score[rows, at]
        keep = (score > NONE) & (score >= least[rows])
        rows, at, score = rows[keep], at[keep], score[keep]
        best = _first(rows, score, block["order"][at], k)
        return rows[best], at[best], score[best]
    # the largest sum of products decides in which numbers all sums are exact
    most = int(np.abs(x.astype(np.int64)).max()) * int(np.abs(q.astype(np.int64)).sum(1).max(initial=0))
    kind = np.float32 if most < 2 ** 24 else np.float64 if most < 2 ** 53 else np.int64
    if "stops" not in block:
        done = np.cumsum(block["impacts"].astype(np.float64) ** 2 * block["sizes"])
        tried = sorted({int(np.searchsorted(done, s * done[-1])) + 1 for s in CHECKS} - {len(done), len(done) + 1})
        settled = _walk(block, q[:SAMPLE], own[:SAMPLE], k, least[:SAMPLE], [*_runs(block, kind, tried)], kind)[3]
        block["stops"] = _paying(block["dims"], settled, len(q[:SAMPLE]))
    runs, out = [*_runs(block, kind, block["stops"])], []
    for lo in range(0, len(q), TILE):
        query, at, score, _ = _walk(block, q[lo:lo + TILE], own[lo:lo + TILE], k, least[lo:lo + TILE], runs, kind)
        out.append((query + lo, at, score))
    return tuple(np.concatenate(c) for c in zip(*out))


def search_block(block: dict, q: np.ndarray, own: np.ndarray, k: int):
    """The k best vectors of a block for each query: (query, positions, scores), see ``block_best``."""
    query, at, score = block_best(block, q, own, k, np.full(len(q), NONE))
    order = np.argsort(query, kind="stable")
    cut = np.searchsorted(query[order], np.arange(len(q) + 1))
    return [(j, at[order[a:b]], score[order[a:b]]) for j, (a, b) in enumerate(zip(cut, cut[1:]))]


def _open(r: dict) -> dict:
    """A stored block for ``block_best``; ``order`` ranks its rows by (vec_id, nulls last, row)."""
    rows, ids = np.frombuffer(r["rows"], np.int64), r["vec_ids"]
    none = np.array([v is None for v in ids], bool)
    sort = np.lexsort((rows, np.array([v or 0 for v in ids], np.int64), none))
    order = np.empty(len(ids), np.int64)
    order[sort] = np.arange(len(ids))
    segments = r["segments"]
    sizes = _numbers(r["sizes"], segments)
    return {"x": _numbers(r["vectors"], r["n"] * r["width"]).reshape(r["n"], r["width"]), "sizes": sizes,
            "dims": _numbers(r["dims"], segments), "impacts": _numbers(r["impacts"], segments).astype(np.int64),
            "postings": _numbers(r["postings"], int(sizes.sum(dtype=np.int64))), "order": order, "rows": rows, "ids": ids,
            "sorted": np.argsort(rows), "wide": _vectors(r, "w_rows", "w_ids", "w", "w_width")}


def _vectors(r: dict, rows: str, ids: str, x: str, width: str) -> tuple:
    """(rows, ids, vectors) of stored wide vectors."""
    n, d = len(r[ids]), r[width]
    return np.frombuffer(r[rows], np.int64), r[ids], np.frombuffer(r[x], np.float64).reshape(n, d) if d else np.zeros((n, 0))


def _answers(blocks: list[dict], r: dict, k: int):
    """Columns (q_row, query_id, row, vec_id, score) of a query batch's k best in the span, and candidates beside
    them by unbounded integers."""
    q_rows, q_ids = np.frombuffer(r["q_rows"], np.int64), r["q_ids"]
    q = _numbers(r["q"], len(q_rows) * r["q_width"]).reshape(len(q_rows), r["q_width"])
    least = np.full(len(q_rows), NONE)
    held = np.full((len(q_rows), k), NONE)          # the k best scores so far
    parts, out = [], {c: [] for c in ("q_row", "query_id", "row", "vec_id", "score")}
    q_wide = _vectors(r, "q_w_rows", "q_w_ids", "q_w", "q_w_width")
    for number, block in enumerate(blocks):
        own = np.full(len(q_rows), -1)
        if len(block["rows"]):
            at = block["sorted"][np.minimum(np.searchsorted(block["rows"], q_rows, sorter=block["sorted"]), len(block["rows"]) - 1)]
            own = np.where(block["rows"][at] == q_rows, at, -1)
        query, at, score = block_best(block, q, own, k, least)
        parts.append((query, score, np.full(len(query), number), at))
        if len(query):
            order = np.argsort(query, kind="stable")
            some, first, count = np.unique(query[order], return_index=True, return_counts=True)
            new = np.full((len(some), k), NONE)
            new[np.repeat(np.arange(len(some)), count), np.arange(len(order)) - np.repeat(first, count)] = score[order]
            held[some] = np.sort(np.concatenate([held[some], new], 1), axis=1)[:, k:]
            least[some] = held[some, 0]
        usual = (block["rows"], block["ids"], block["x"])
        for a, b in (((q_rows, q_ids, q), block["wide"]), (q_wide, usual), (q_wide, block["wide"])):
            for found in _wide_best(a, b, k):
                for c, v in zip(out, found):
                    out[c].append(v)
    query, score, number, at = (np.concatenate([p[c] for p in parts]) for c in range(4))
    row, ids = np.zeros(len(query), np.int64), np.zeros(len(query), object)
    for b in np.unique(number).tolist():
        mine = number == b
        row[mine] = blocks[b]["rows"][at[mine]]
        ids[mine] = [blocks[b]["ids"][a] for a in at[mine].tolist()]
    none = np.array([v is None for v in ids], bool)
    sort = np.lexsort((row, np.array([v or 0 for v in ids], np.int64), none))
    order = np.empty(len(ids), np.int64)
    order[sort] = np.arange(len(ids))
    best = _first(query, score, order, k)
    out["q_row"] += q_rows[query[best]].tolist()
    out["query_id"] += [q_ids[j] for j in query[best].tolist()]
    out["row"] += row[best].tolist()
    out["vec_id"] += ids[best].tolist()
    out["score"] += score[best].tolist()
    return out


def top_k(vectors: DataFrame, is_query, k: int = 5, vec_id: str = "vec_id",
          embedding: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): for every row for which ``is_query`` holds (a condition on
    ``vec_id``) its k best other rows, all if fewer.

    Score: integer inner product; components that only one of two vectors has count as zero. Ties go
    to the smaller vec_id, null ids last (scores beyond 64 bits count as the nearest 64-bit integer, so they
    tie and go to the smaller vec_id). A repeated vec_id is a query per row, and the other rows
    with that id are candidates. Rows without a usable vector take no part; an empty table gives none.
    """
    spark = vectors.sparkSession
    ints = impacts(vectors, vec_id, embedding)
    queries = ints.where(is_query)
    # three numbers, to size blocks, batches and spans
    n, size = ints.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size("x").cast("long")), F.lit(0))).first()
    m = queries.count()
    blocks, batches = max(1, -(-n // BLOCK), -(-size // VALUES)), max(1, -(-m // QUERIES))
    spans = max(-(-size // SPAN), min(blocks, TASKS * spark.sparkContext.defaultParallelism))
    # the stated query set against all rows: a span's blocks, then all batches
    index = written(build_index(ints, blocks), "impact-index", GROUP).withColumn("span", F.col("block") % spans)
    asked = written(query_batches(queries, batches), "impact-queries", GROUP).withColumn(
        "span", F.explode(F.sequence(F.lit(0), F.lit(spans - 1))))
    pairs = (index.unionByName(asked, allowMissingColumns=True).repartitionById(spans, "span")
             .sortWithinPartitions("span", F.asc_nulls_last("block"), "batch"))

    def search(batches_):
        span, held = None, []
        for rb in batches_:
            for i in range(rb.num_rows):
                r = rb.slice(i, 1).to_pylist()[0]
                if r["span"] != span:
                    span, held = r["span"], []
                if r["block"] is not None:
                    held.append(_open(r))
                elif held:
                    found = _answers(held, r, k)
                    yield pa.RecordBatch.from_pydict({c: pa.array(v, pa.int64()) for c, v in found.items()})

    best = pairs.mapInArrow(search, "q_row long, query_id long, row long, vec_id long, score long")
    w = W.partitionBy("q_row").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "row")
    return (best.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
