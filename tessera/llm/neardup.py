"""MinHash near-dedup with an LSH forest.

Documents are sets of distinct 5-word shingles; two are linked when 100 * intersection >= 75 * union.

1. Sets. Documents with equal sets are one *node* from here on (a hash of the set), so a group of
   exact copies of any size costs one row. A node gets ``TREES * DEPTH`` min-hashes.
2. Forest. Each of ``TREES`` orders sorts all nodes by a signature of its own, ``DEPTH`` min-hashes. Neighbours
   in an order have a longest common prefix; a run whose neighbours share ``LEAST`` values or more is a region.
   A region of at most ``REGION`` nodes is compared whole: all pairs by a 2-bit sketch of 128 min-hashes, and
   only a spanning star of the *loose* links (estimate at or above ``LOOSE``) leaves the task. In a larger region
   the depth adapts: it is cut where the common prefix is shorter than one value more, and so on until the parts are
   small enough. A part that is too large at full depth is dealt into blocks, one task per pair of blocks.
   A greater depth finds fewer pairs, so all nodes of regions that were cut stand in ``DEEP_TREES`` more orders
   (other choices among the node's min-hashes), whose regions share ``DEEP`` values and are compared whole.
   Two sets at similarity 0.75 share no region in any order with probability (1 - 0.75 ** LEAST) ** TREES = 1.7e-5
   at the first depth and (1 - 0.75 ** DEEP) ** DEEP_TREES = 3e-8 at the second (about 1e-5 as its orders share
   min-hashes); the sketch misses one with about 1e-5.
3. Loose groups: connected components of the loose links (``components``).
4. Links. The full sets of the members of loose groups are brought together by group and all pairs
   of a group are confirmed exactly, through an inverted index in the task. A group whose sets hold
   more than ``BLOCK`` shingles is dealt into blocks, one task per pair of blocks: the exact way for
   groups of any size, in bounded memory. Confirmed links (spanning ones) give the components.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tessera.llm import textvec as tv
from tessera.llm.common import fresh, written
from tessera.llm.components import components
from tessera.llm.decontam import bitmap, passes

SHINGLE = 5
SIMILAR = 75                # per cent of the union
TREES, DEPTH, LEAST = 20, 8, 3
DEEP_TREES, DEEP = 64, 5    # orders and depth for the nodes of large regions
SKETCH = 128                # min-hashes in the sketch, two bits each
LOOSE = 0.55
REGION = 2048               # nodes compared in one go; larger regions are cut or dealt into blocks of half of it
BLOCK = 1 << 20             # shingles in a block at most (a single larger set is a block)
SPREAD = 8192
MULTIPLIERS = np.random.default_rng(75).integers(1, 2 ** 63, TREES * DEPTH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LANES = np.uint64(0x5555555555555555)
# min-hashes of every order, first to last
FIRST_ORDERS = np.arange(TREES * DEPTH).reshape(TREES, DEPTH)
DEEP_ORDERS = np.array([np.random.default_rng([76, t]).permutation(TREES * DEPTH)[:DEEP] for t in range(DEEP_TREES)])
NEED = int(np.ceil(SKETCH * (LOOSE + (1 - LOOSE) / 4)))


def node_of(shingles: np.ndarray) -> int:
    """Hash of a set of shingles (64 bits, signed)."""
    return int(tv.sequence_hash(shingles).view(np.int64))


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """Min-hashes (sets x TREES * DEPTH, uint32) of non-empty sets."""
    flat = np.concatenate(sets)
    starts = np.cumsum([0] + [len(s) for s in sets[:-1]])
    out = np.empty((len(sets), TREES * DEPTH), np.uint32)
    tmp = np.empty_like(flat)
    for k, m in enumerate(MULTIPLIERS):
        np.multiply(flat, m, out=tmp)
        out[:, k] = np.minimum.reduceat(tmp, starts) >> np.uint64(32)
    return out


def documents_and_nodes(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    """(doc_id, tie, n_shingles, node, sig binary): one row per document; node is null without words."""

    def rows(batches):
        for batch in batches:
            for part in tv.bounded_slices(batch, "text", 1 << 20):
                sets = tv.shingle_sets(*tv.utf8(part.column("text")), SHINGLE)
                some = [s for s in sets if len(s)]
                sig = iter(signatures(some) if some else [])
                yield pa.RecordBatch.from_pydict({
                    "doc_id": part.column("doc_id"), "tie": part.column("tie"),
                    "n_shingles": pa.array([len(s) for s in sets], pa.int64()),
                    "node": pa.array([node_of(s) if len(s) else None for s in sets], pa.int64()),
                    "sig": pa.array([next(sig).astype(">u4").tobytes() if len(s) else None for s in sets], pa.binary())})

    return (docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(text).alias("tie"),
                        F.col(text).alias("text"))
            .mapInArrow(rows, "doc_id long, tie long, n_shingles long, node long, sig binary"))


def region_of(keys: np.ndarray) -> np.ndarray:
    """Hash of (order, first values) rows."""
    h = np.zeros(len(keys), np.uint64)
    for c in range(keys.shape[1]):
        h = tv.mix((h ^ keys[:, c].astype(np.uint64)) * tv._STEP + np.uint64(1))
    return h


def forest(nodes: DataFrame, orders: np.ndarray, depth: int, only=None) -> DataFrame:
    """(region, key, node, n, sketch): every node once per order. ``key`` is the number of the order and the
    node's signature in it (big-endian, so it sorts as the values do), ``region`` a hash of the order and the first
    ``depth`` values; with ``only``, the regions that pass this bitmap."""
    def rows(batches):
        lanes = np.arange(SKETCH // 4, dtype=np.uint64)
        for batch in batches:
            for k in range(0, batch.num_rows, 2000):
                part = batch.slice(k, 2000)
                m = part.num_rows
                sig = np.frombuffer(b"".join(part.column("sig").to_pylist()), ">u4").reshape(m, TREES * DEPTH)
                low = sig[:, :SKETCH].astype(np.uint64) & np.uint64(3)
                sketch = (low.reshape(m, 4, SKETCH // 4) << (2 * lanes)).sum(2, dtype=np.uint64)
                node, n = part.column("node"), part.column("n")
                sketches = pa.array([s.tobytes() for s in sketch], pa.binary())
                for t, places in enumerate(orders):
                    key = np.empty((m, 1 + len(places)), ">u4")
                    key[:, 0] = t
                    key[:, 1:] = sig[:, places]
                    region = region_of(key[:, :1 + depth])
                    out = pa.RecordBatch.from_pydict({
                        "region": pa.array(region.view(np.int64), pa.int64()),
                        "key": pa.array([x.tobytes() for x in key], pa.binary()), "node": node, "n": n, "sketch": sketches})
                    yield out if only is None else out.filter(pa.array(passes(only.value, region)))

    return nodes.mapInArrow(rows, "region long, key binary, node long, n long, sketch binary")


def _loose(sketch: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Smallest index that each row of a region is loosely connected with."""
    s = len(n)
    near = np.empty((s, s), bool)
    for a in range(0, s, 256):
        x = sketch[a:a + 256, None, :] ^ sketch[None, :, :]
        agree = SKETCH - np.bitwise_count((x | (x >> np.uint64(1))) & _LANES).sum(2)
        lo = np.minimum(n[a:a + 256, None], n[None, :])
        hi = np.maximum(n[a:a + 256, None], n[None, :])
        near[a:a + 256] = (agree >= NEED) & (100 * lo >= SIMILAR * hi)
    label = np.arange(s)
    while True:
        new = np.minimum(label, np.where(near, label[None, :], s).min(1))
        new = np.minimum(new, new[new])
        if (new == label).all():
            return label
        label = new


def _sketches(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint64).reshape(len(column), SKETCH // 32)


class _Order:
    """One task's part of the sorted orders, row by row: only the open region's rows are held, and of a region
    that outgrows ``4 * REGION`` rows only its open part."""

    def __init__(self, width: int, depth: int):
        self.width, self.depth = width, depth           # values in a key; least common prefix of a region
        self.held = None                                # keys, node, n, sketch
        self.cut = (np.zeros(0), depth)                        # a region whose first part is done, and its depth now
        self.skip, self.passed = None, 0                # a whole key with too many rows, and how many passed

    def feed(self, now=None):
        """(a, b, large regions, their sizes, nodes of cut regions) after these rows; None ends the order."""
        self.a, self.b, self.large, self.deep = [], [], [], []
        if now is not None:
            self.held = now if self.held is None else [np.concatenate(p) for p in zip(self.held, now)]
        if self.held is not None:
            self._pass(now is None)
            self._regions(now is None)
        none = np.zeros(0, np.int64)
        return (np.concatenate([none, *self.a]), np.concatenate([none, *self.b]), [r for r, _ in self.large],
                [s for _, s in self.large], np.concatenate([none, *self.deep]))

    def _drop(self, rows: int) -> None:
        self.held = [p[rows:] for p in self.held]

    def _pass(self, final: bool) -> None:
        if self.skip is None:
            return
        other = np.flatnonzero((self.held[0] != self.skip).any(1))
        count = int(other[0]) if len(other) else len(self.held[0])
        self._mark(0, count)
        self.passed += count
        self._drop(count)
        if len(self.held[0]) or final:
            self.large.append((int(region_of(self.skip[None, :]).view(np.int64)[0]), self.passed))
            self.skip = None

    def _regions(self, final: bool) -> None:
        keys = self.held[0]
        m = len(keys)
        if not m:
            return
        same = np.logical_and.accumulate(keys[1:] == keys[:-1], axis=1)
        self.prefix = np.concatenate([[-1], same.sum(1) - 1])       # values shared with the row before; -1: other order
        first = np.flatnonzero(self.prefix < self.depth)
        first[0] = 0
        size = np.diff(np.append(first, m))
        if not final:
            first, size, last = first[:-1], size[:-1], int(first[-1])
        if len(first) and np.array_equal(keys[0, :1 + self.depth], self.cut[0]):
            self._mark(0, int(size[0]))                 # the rest of a region that was cut before
            self._split(0, int(size[0]), self.cut[1])
            first, size = first[1:], size[1:]
        self._pairs(first[size == 2])
        for f, s in zip(first[size > 2].tolist(), size[size > 2].tolist()):
            if s > REGION:
                self._large(f, s)
            else:
                self._whole(f, s)
        if final:
            self.held = None
        else:
            if m - last > 4 * REGION:
                last = self._outgrown(last, m)
            self._drop(last)

    def _large(self, f: int, s: int) -> None:
        if self.depth < self.width:
            self._mark(f, s)
            self._split(f, s, self.depth + 1)
        else:
            self.large.append((int(region_of(self.held[0][f:f + 1]).view(np.int64)[0]), s))

    def _outgrown(self, f: int, m: int) -> int:
        """The open region has too many rows to hold: its closed parts are done; the row where the open one starts."""
        name = self.held[0][f, :1 + self.depth].copy()
        for depth in range(min(self.depth + 1, self.width), self.width + 1):
            at = f + int(np.flatnonzero(self.prefix[f:m] < depth)[-1]) if (self.prefix[f:m] < depth).any() else f
            if m - at <= 2 * REGION:
                break
        if at > f:
            self._mark(f, at - f)
            self._split(f, at - f, depth)
        self.cut = (name, depth)
        if m - at > 2 * REGION:                         # equal keys
            self.skip, self.passed = self.held[0][at].copy(), m - at
            self._mark(at, m - at)
            return m
        return at

    def _mark(self, f: int, s: int) -> None:
        if self.depth < self.width:
            self.deep.append(self.held[1][f:f + s])

    def _split(self, f: int, s: int, depth: int) -> None:
        edges = np.concatenate([[f], f + 1 + np.flatnonzero(self.prefix[f + 1:f + s] < depth), [f + s]])
        for lo, hi in zip(edges[:-1].tolist(), edges[1:].tolist()):
            if hi - lo > REGION:
                if depth < self.width:
                    self._split(lo, hi - lo, depth + 1)
                else:
                    self.large.append((int(region_of(self.held[0][lo:lo + 1]).view(np.int64)[0]), hi - lo))
            elif hi - lo > 1:
                self._whole(lo, hi - lo)

    def _pairs(self, two: np.ndarray) -> None:
        _, node, n, sketch = self.held
        x = sketch[two] ^ sketch[two + 1]
        agree = SKETCH - np.bitwise_count((x | (x >> np.uint64(1))) & _LANES).sum(1)
        lo, hi = np.minimum(n[two], n[two + 1]), np.maximum(n[two], n[two + 1])
        ok = two[(agree >= NEED) & (100 * lo >= SIMILAR * hi)]
        self.a.append(node[ok])
        self.b.append(node[ok + 1])

    def _whole(self, f: int, s: int) -> None:
        _, node, n, sketch = self.held
        root = _loose(sketch[f:f + s], n[f:f + s])
        moved = np.flatnonzero(root != np.arange(s))
        self.a.append(node[f:f + s][moved])
        self.b.append(node[f:f + s][root[moved]])


def region_links(trees: DataFrame, width: int, depth: int) -> DataFrame:
    """(a, b, region, size, deep) of ``forest`` orders of ``width`` values: spanning links (a, b) of nodes that look
    similar in a region; the hash and size of every whole key that more than REGION nodes share; the nodes of
    regions that were cut deeper than ``depth``. The other columns of a row are null."""
    # a region lies in one sorted run: orders are streamed, a region is never gathered as a group
    sorted_ = trees.repartition("region").sortWithinPartitions("key", "node")

    def rows(batches):
        order = _Order(width, depth)

        def out(a, b, regions, sizes, deep):
            counts = [len(a), len(regions), len(deep)]
            fill = lambda k, values: pa.array(
                [None] * sum(counts[:k]) + list(values) + [None] * sum(counts[k + 1:]), pa.int64())
            return pa.RecordBatch.from_pydict({
                "a": fill(0, a.tolist()), "b": fill(0, b.tolist()), "region": fill(1, regions), "size": fill(1, sizes),
                "deep": fill(2, deep.tolist())})

        for batch in batches:
            if batch.num_rows:
                keys = np.frombuffer(b"".join(batch.column("key").to_pylist()), ">u4").reshape(batch.num_rows, 1 + width)
                yield out(*order.feed([keys, batch.column("node").to_numpy(), batch.column("n").to_numpy(),
                                       _sketches(batch.column("sketch"))]))
        yield out(*order.feed())

    return sorted_.mapInArrow(rows, "a long, b long, region long, size long, deep long")


def block_links(trees: DataFrame, large: DataFrame) -> DataFrame:
    """(a, b): spanning links of nodes that look similar in the ``large(region, size)`` regions, all pairs
    compared: the nodes are dealt into blocks, one task per pair of blocks."""
    member = (trees.join(large, "region")
              .withColumn("_blocks", F.ceil(F.col("size") / (REGION // 2)).cast("int"))
              .withColumn("_own", F.pmod(F.xxhash64("node"), F.col("_blocks")).cast("int"))
              .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
              # the pair of a block with itself is part of each of its other pairs
              .where(F.col("_other") != F.col("_own"))
              .select("region", F.least("_own", "_other").alias("i"), F.greatest("_own", "_other").alias("j"),
                      "node", "n", "sketch"))

    def linked(table: pa.Table) -> pa.Table:
        node = table.column("node").to_numpy()
        root = _loose(_sketches(table.column("sketch")), table.column("n").to_numpy())
        moved = np.flatnonzero(root != np.arange(len(root)))
        return pa.table({"a": pa.array(node[moved], pa.int64()), "b": pa.array(node[root[moved]], pa.int64())})

    return member.groupBy("region", "i", "j").applyInArrow(linked, "a long, b long")


def _order_links(nodes: DataFrame, orders: np.ndarray, depth: int, name: str) -> tuple[DataFrame, DataFrame]:
    """((a, b) of these orders, (node) of regions that were cut)."""
    width = orders.shape[1]
    found = written(region_links(forest(nodes, orders, depth), width, depth), name)
    links = found.where("a is not null").select("a", "b")
    large = found.where("region is not null").groupBy("region").agg(F.sum("size").alias("size"))
    if not large.isEmpty():
        only = nodes.sparkSession.sparkContext.broadcast(bitmap(large, "region"))      # fixed size
        links = links.unionByName(block_links(forest(nodes, orders, width, only), large))
    return links, found.where("deep is not null").select(F.col("deep").alias("node")).distinct()


def loose_links(nodes: DataFrame) -> DataFrame:
    """(a, b): spanning links of ``nodes(node, n, sig)`` that look similar in some region of some order."""
    links, deep = _order_links(nodes, FIRST_ORDERS, LEAST, "region-links")
    if deep.isEmpty():
        return links
    again = written(nodes.join(deep, "node", "left_semi"), "deep-nodes")
    return links.unionByName(_order_links(again, DEEP_ORDERS, DEEP, "deep-links")[0])


def sets_of(texts: DataFrame, bits) -> DataFrame:
    """(node, shingles binary) of the ``texts(tie, text)`` whose hash passes the bitmap, once per
    slice and text (other repeats, and the bitmap's few false passes, are left to the caller)."""

    def rows(batches):
        for batch in batches:
            for part in tv.bounded_slices(batch, "text", 1 << 20):
                tie, first = np.unique(part.column("tie").to_numpy(), return_index=True)
                part = part.take(pa.array(first[passes(bits.value, tie.view(np.uint64))]))
                sets = [s for s in tv.shingle_sets(*tv.utf8(part.column("text")), SHINGLE) if len(s)]
                yield pa.RecordBatch.from_pydict({
                    "node": pa.array([node_of(s) for s in sets], pa.int64()),
                    "shingles": pa.array([s.tobytes() for s in sets], pa.binary())})

    return texts.mapInArrow(rows, "node long, shingles binary")


def exact_links(sets: list[np.ndarray]) -> np.ndarray:
    """Smallest index that each set is connected with through links (100 * inter >= 75 * union)."""
    s = len(sets)
    n = np.array([len(x) for x in sets], np.int64)
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(s), n)
    order = np.argsort(flat, kind="stable")
    value = flat[order]
    same = np.zeros(len(value), bool)
    same[1:] = value[1:] == value[:-1]
    same[:-1] |= same[1:]
    order = order[same]                                  # shingles of one set alone link nothing
    group = np.cumsum(np.concatenate([[0], flat[order][1:] != flat[order][:-1]])) if len(order) else order
    doc = owner[order]                                   # postings, sorted by shingle then set
    first = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]])) if len(order) else order
    size = np.diff(np.concatenate([first, [len(order)]]))
    by_doc = np.argsort(doc, kind="stable")
    doc_first = np.searchsorted(doc[by_doc], np.arange(s + 1))
    root = np.arange(s)

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i in range(s):
        mine = group[by_doc[doc_first[i]:doc_first[i + 1]]]
        if not len(mine):
            continue
        long = size[mine]
        at = np.repeat(first[mine] - (np.cumsum(long) - long), long) + np.arange(int(long.sum()))
        inter = np.bincount(doc[at], minlength=s)
        inter[:i + 1] = 0
        for j in np.flatnonzero(100 * inter >= SIMILAR * (n + n[i] - inter)):
            a, b = find(i), find(int(j))
            if a != b:
                root[max(a, b)] = min(a, b)
    return np.array([find(i) for i in range(s)])


def confirmed_links(sets: DataFrame, groups: DataFrame) -> DataFrame:
    """(a, b): spanning links inside loose ``groups(node, component, n)``, confirmed on full sets."""
    sizes = groups.groupBy("component").agg(F.sum("n").alias("_all"), F.count(F.lit(1)).alias("_members"))
    # no block above BLOCK shingles; groups of many members are dealt further, by the root of their
    # size, so that a large group's pairs of blocks spread over tasks
    spread = F.least(F.ceil(F.sqrt(F.col("_all") / SPREAD)), F.ceil(F.col("_members") / 64))
    blocks = F.greatest(F.ceil(F.col("_all") / BLOCK), spread).cast("int")
    member = (groups.join(sizes, "component").withColumn("_blocks", blocks)
              .withColumn("_own", F.pmod(F.xxhash64("node"), F.col("_blocks")).cast("int"))
              # a node meets every block of its group: one row per pair of blocks that holds its own
              .select("node", "component", F.explode(F.transform(
                  F.sequence(F.lit(0), F.col("_blocks") - 1), lambda o: F.struct(
                      F.least(o, F.col("_own")).alias("i"), F.greatest(o, F.col("_own")).alias("j")))).alias("p"))
              .select("node", "component", "p.i", "p.j"))
    # Copies of a set are equal: one is kept.
    dealt = sets.dropDuplicates(["node"]).join(member, "node")

    def linked(table: pa.Table) -> pa.Table:
        node = table.column("node").to_numpy()
        root = exact_links([np.frombuffer(x.as_py(), np.uint64) for x in table.column("shingles")])
        moved = np.flatnonzero(root != np.arange(len(root)))
        return pa.table({"a": pa.array(node[moved], pa.int64()), "b": pa.array(node[root[moved]], pa.int64())})

    return dealt.groupBy("component", "i", "j").applyInArrow(linked, "a long, b long")


def near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, tie, n_shingles, node, component_id, kept) for every row of ``docs``.

    ``component_id`` is the smallest doc_id that a document is connected with by links, itself
    included; ``kept`` says whether it is the document's own. Null and empty texts have no shingle:
    they are linked with nothing. A null doc_id counts as larger than any other (a component of null
    doc_ids alone has a null id and keeps nothing). Rows that repeat a doc_id get a row each.
    ``tie`` is the hash of the text.
    """
    spark = docs.sparkSession
    own = written(documents_and_nodes(docs, text, doc_id), "doc-nodes")
    nodes = own.where("node is not null").groupBy("node").agg(
        F.min("doc_id").alias("least_id"), F.min("tie").alias("tie"), F.max("n_shingles").alias("n"),
        F.first("sig").alias("sig"))
    nodes = written(nodes, "nodes")
    loose = written(components(loose_links(nodes.select("node", "n", "sig")))
                    .join(nodes.select("node", "tie", "n"), "node"), "loose-groups")
    shared = spark.sparkContext.broadcast(bitmap(loose, "tie"))        # fixed size
    texts = docs.select(F.xxhash64(text).alias("tie"), F.col(text).alias("text")).where(F.col(text).isNotNull())
    links = confirmed_links(sets_of(texts, shared), loose.drop("tie"))
    found = components(links)
    home = nodes.join(found, "node", "left").select(
        "node", "least_id", F.coalesce("component", "node").alias("component"))
    ids = home.groupBy("component").agg(F.min("least_id").alias("component_id"))
    final = written(home.join(ids, "component").select("node", "component_id"), "node-components")
    joined = own.drop("sig").join(final, "node", "left").withColumn(
        "component_id", F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id")))
    return joined.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))


def keep_one(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``docs`` with one document of each near-duplicate group (the smallest doc_id; of repeated rows
    with that doc_id one). Documents without words are in no group and all stay."""
    found = near_duplicates(docs, text, doc_id)
    first = found.where("node is not null").groupBy("component_id").agg(
        F.min(F.struct(F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).cast("int") * -1,
                       F.col("doc_id"), F.col("tie"))).alias("best"))
    tie, k_id, k_tie = (fresh(docs, c) for c in ("_tie", "_keep_id", "_keep_tie"))
    stay = first.select(F.col("best.doc_id").alias(k_id), F.col("best.tie").alias(k_tie)).distinct()
    tied = docs.withColumn(tie, F.xxhash64(text))
    wordless = F.col(text).isNull() | ~F.col(text).rlike("[^ \\t-\\r]")
    kept = tied.where(~wordless).join(stay, F.col(doc_id).cast("long").eqNullSafe(F.col(k_id))
                                      & (F.col(tie) == F.col(k_tie)), "left_semi")
    return kept.dropDuplicates([doc_id, tie]).drop(tie).unionByName(docs.where(wordless))
