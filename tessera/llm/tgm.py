"""Exact n-gram Jaccard join over a token-group matrix.

Documents are sets of distinct 4-word shingles (tokens); two are linked when 100 * intersection >= 85 *
union. Documents with equal sets (128-bit hash) are one *node*.

1. Groups. A node keeps its 16 smallest tokens; of these the one that most nodes keep is its key. Nodes
   with one key and about one size form a group: near copies meet, a document like no other is alone.
   A group of more than ``MEMBERS`` nodes or ``TOKENS`` tokens is dealt into several.
2. Matrix. Tokens have one global order (those that many nodes keep come last). Of each set the first
   15 % count, and of these those that other sets may have too; a group's entries are the union of its
   members': token, the most tokens of a member that follow it (itself included), the smallest set.
3. Bound. Two sets at the limit share a first token, and all that they share follows it in both. So two
   groups can only hold a link if they have a common entry with min(following) * 185 >= 85 * (smallest +
   smallest); the smaller set's entry lies in its first 8 %. The same holds for two members of one group.
   Other pairs of groups are never opened. No pair at the limit is lost: the bound holds for its own first
   common token.
4. Meet. The members with a qualifying entry of a qualifying pair of groups meet in the task of one of
   the two, its home (bounded by the group limits and ``ROOM``), so a group is sent there once for all the
   pairs it is home of. First their sketches meet: a bit for every place that an odd number of the set's
   tokens fall on. Two sketches differ in no more places than the sets differ in tokens, so a pair whose
   sketches differ too much is no link, and a member without a near partner is not opened.
5. Open. The full sets of the others follow. A member takes part if its overlap with the other group's whole
   token union allows a link; the rest are compared exactly through an inverted index. Spanning links leave
   the task.
6. ``components`` of the links.

Sets are never stored but for opened groups; they are made anew from the texts. The order, the choice of
groups and the sketches only decide how much is opened, never what is linked. Tokens are 64-bit hashes.
"""
from __future__ import annotations

import gc

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from tessera.llm import textvec as tv
from tessera.llm.common import written
from tessera.llm.components import components
from tessera.llm.decontam import bitmap, passes

SHINGLE = 4
SIMILAR = 85                # per cent of the union
LOW = 16                    # smallest tokens that decide the group
SHARED = 4                  # nodes that keep a token before it counts as frequent
MEMBERS = 512               # nodes of a group, about
TOKENS = 1 << 18            # tokens of a group, about (a larger set is a group)
ROOM = 1 << 20              # tokens of other groups that meet a group in one task, about
_SECOND = np.uint64(0x94D049BB133111EB)


def identity(tokens: np.ndarray) -> tuple[int, int]:
    """128-bit hash of a set."""
    other = tv.mix(tokens * _SECOND + np.uint64(1))
    return int(tv.sequence_hash(tokens).view(np.int64)), int(tv.sequence_hash(other).view(np.int64))


def sketch(tokens: np.ndarray) -> bytes:
    """Parity of the set's tokens on each of 2 ** k places, n / 2 to n of them (64 at least)."""
    bits = max(6, (len(tokens) - 1).bit_length() - 1) if len(tokens) else 6
    odd = np.bincount((tokens & np.uint64((1 << bits) - 1)).astype(np.int64), minlength=1 << bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def folded(sketches: list[bytes], size: int) -> np.ndarray:
    """Sketches as rows of ``size`` bytes: longer ones are folded, which keeps the parity of each place."""
    return np.array([np.bitwise_xor.reduce(np.frombuffer(x, np.uint8).reshape(-1, size)) for x in sketches])


def near(own: list[bytes], n_own: np.ndarray, other: list[bytes] | None, n_other: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which sets of own, and of other, may have a link to the other side; with ``other`` None inside own."""
    size = min(map(len, own + (other or [])))
    left = folded(own, size)
    right = left if other is None else folded(other, size)
    some, met = np.zeros(len(left), bool), np.zeros(len(right), bool)
    for i in range(len(left)):
        apart = np.bitwise_count((left[i] ^ right).view(np.uint64)).sum(axis=1, dtype=np.int64)
        apart = np.maximum(apart, np.abs(n_own[i] - n_other))
        # at the limit the sets differ in (100 - SIMILAR) / (100 + SIMILAR) of their tokens
        able = (100 + SIMILAR) * apart <= (100 - SIMILAR) * (n_own[i] + n_other)
        if other is None:
            able[i] = False
        some[i] = able.any()
        met |= able
    return some, met


def _set_rows(batches, keep=None):
    """(slice of documents, their sets) of Arrow batches; ``keep(part)`` chooses rows first."""
    for batch in batches:
        for part in tv.bounded_slices(batch, "text", 1 << 20):
            if keep is not None:
                part = part.take(pa.array(keep(part)))
            if part.num_rows:
                yield part, tv.shingle_sets(*tv.utf8(part.column("text")), SHINGLE)


def documents(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    """(doc_id, tie, n, hi, lo, low, sketch): one row per document; hi and lo are null without words."""

    def rows(batches):
        for part, sets in _set_rows(batches):
            ids = [identity(s) if len(s) else (None, None) for s in sets]
            yield pa.RecordBatch.from_pydict({
                "doc_id": part.column("doc_id"), "tie": part.column("tie"),
                "n": pa.array([len(s) for s in sets], pa.int64()),
                "hi": pa.array([h for h, _ in ids], pa.int64()), "lo": pa.array([x for _, x in ids], pa.int64()),
                "low": pa.array([s[:LOW].view(np.int64) for s in sets], pa.list_(pa.int64())),
                "sketch": pa.array([sketch(s) if len(s) else None for s in sets], pa.binary())})

    return (docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(text).alias("tie"),
                        F.col(text).alias("text"))
            .mapInArrow(rows, "doc_id long, tie long, n long, hi long, lo long, low array<long>, sketch binary"))


def grouped(nodes: DataFrame, kept: DataFrame) -> DataFrame:
    """(node, hi, lo, n, tie, group) of ``nodes``; ``kept(token, nodes)``: tokens that several nodes keep."""
    common = (nodes.select("node", F.explode("low").alias("token")).join(kept, "token").groupBy("node")
              .agg(F.max_by("token", F.struct("nodes", "token")).alias("common")))
    keyed = nodes.join(common, "node", "left").select(
        "node", "hi", "lo", "n", "tie", F.coalesce("common", F.col("low")[0]).alias("key"),
        F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(100 / SIMILAR))).alias("band"))
    size = keyed.groupBy("key", "band").agg(F.greatest(
        F.ceil(F.count(F.lit(1)) / MEMBERS), F.ceil(F.sum("n") / TOKENS)).alias("parts"))
    return keyed.join(size, ["key", "band"]).select(
        "node", "hi", "lo", "n", "tie",
        F.xxhash64("key", "band", F.pmod(F.xxhash64("node"), F.col("parts"))).alias("group"))


def prefixes(docs: DataFrame, text: str, frequent) -> DataFrame:
    """(hi, lo, prefix): the first tokens of every distinct set, in the global order."""

    def rows(batches):
        for part, sets in _set_rows(batches):
            seen = {}
            for s in sets:
                if len(s) and (key := identity(s)) not in seen:
                    late = passes(frequent.value, s)
                    count = len(s) - (SIMILAR * len(s) + 99) // 100 + 1
                    first = s[~late][:count]
                    seen[key] = np.concatenate([first, s[late][:count - len(first)]])
            yield pa.RecordBatch.from_pydict({
                "hi": pa.array([h for h, _ in seen], pa.int64()), "lo": pa.array([x for _, x in seen], pa.int64()),
                "prefix": pa.array([p.tobytes() for p in seen.values()], pa.binary())})

    return docs.select(F.col(text).alias("text")).mapInArrow(rows, "hi long, lo long, prefix binary")


def shared_tokens(first: DataFrame) -> DataFrame:
    """(token, group, node, n, rest) of the tokens of ``first(group, node, n, prefix)`` that several nodes
    hold; ``rest``: how many of the set's tokens follow, the token included.

    Most tokens are in one prefix only. Each is sent once, to its hash, and leaves the task only if it is
    not alone there."""

    def rows(batches):
        for batch in batches:
            names = batch.schema.names
            wide = batch.column("prefix").cast(pa.large_binary())
            for part in tv.bounded_slices(batch.set_column(names.index("prefix"), "prefix", wide), "prefix"):
                prefix = part.column("prefix").to_pylist()
                size = np.array([len(p) // 8 for p in prefix], np.int64)
                token = np.frombuffer(b"".join(prefix), np.int64)
                row = np.repeat(np.arange(len(size)), size)
                n = part.column("n").to_numpy()[row]
                yield pa.RecordBatch.from_pydict({
                    "token": pa.array(token), "group": pa.array(part.column("group").to_numpy()[row]),
                    "node": pa.array(part.column("node").to_numpy()[row]), "n": pa.array(n),
                    "rest": pa.array(n - (np.arange(len(token)) - (np.cumsum(size) - size)[row]))})

    every = first.select("group", "node", "n", "prefix").mapInArrow(
        rows, "token long, group long, node long, n long, rest long")
    return (every.withColumn("holders", F.count(F.lit(1)).over(W.partitionBy("token")))
            .where("holders > 1").drop("holders"))


def matrix(tokens: DataFrame) -> DataFrame:
    """(token, group, rest, least, members) of ``shared_tokens``: each group's token union, with the most
    tokens of a member from the token on, the smallest set and the number of members that hold it."""
    return tokens.groupBy("token", "group").agg(
        F.max("rest").alias("rest"), F.min("n").alias("least"), F.count(F.lit(1)).alias("members"))


def qualifying(entries: DataFrame) -> DataFrame:
    """(g, h, token): pairs of groups with a common entry that allows a link, g <= h (g = h: inside one)."""
    both = 100 + SIMILAR
    # the smaller set's first common token leaves it room for the whole overlap of two sets of its size
    short = entries.where(F.col("rest") * both >= 2 * SIMILAR * F.col("least"))
    own = short.where("members > 1").select(F.col("group").alias("g"), F.col("group").alias("h"), "token")
    able = (F.col("g") != F.col("group")) & (
        F.least("r", "rest") * both >= SIMILAR * (F.col("l") + F.col("least")))
    short = short.select("token", F.col("group").alias("g"), F.col("rest").alias("r"), F.col("least").alias("l"))
    pairs = (short.join(entries, "token").where(able)
             .select(F.least("g", "group").alias("g"), F.greatest("g", "group").alias("h"), "token"))
    return pairs.unionByName(own).distinct()


def opened_links(own: list[np.ndarray], other: list[np.ndarray] | None) -> list[tuple[int, int]]:
    """Spanning links between the sets of two groups (indices into own, then other); with ``other`` None
    inside one group. Exact."""
    sets = own + (other or [])
    n = np.array([len(s) for s in sets], np.int64)
    cut = len(own) if other is not None else 0
    take = np.ones(len(sets), bool)
    if other is not None:       # bound: a member's overlap with the other group's token union
        for side, rest in ((range(cut), range(cut, len(sets))), (range(cut, len(sets)), range(cut))):
            union = np.unique(np.concatenate([sets[k] for k in rest]))
            least = min(n[k] for k in rest)
            for k in side:
                inside = int((union[np.minimum(np.searchsorted(union, sets[k]), len(union) - 1)] == sets[k]).sum())
                take[k] = (100 + SIMILAR) * inside >= SIMILAR * (n[k] + max(least, (SIMILAR * n[k] + 99) // 100))
    left = np.flatnonzero(take)
    if len(left) < 2 or (other is not None and (left[-1] < cut or left[0] >= cut)):
        return []
    flat = np.concatenate([sets[k] for k in left])
    owner = np.repeat(np.arange(len(left)), n[left])
    order = np.argsort(flat, kind="stable")
    value, holder = flat[order], owner[order]
    edge = np.flatnonzero(np.concatenate([[True], value[1:] != value[:-1]]))
    size = np.diff(np.append(edge, len(value)))
    code = np.empty(len(flat), np.int64)
    code[order] = np.repeat(np.arange(len(edge)), size)
    places = np.concatenate([[0], np.cumsum(n[left])])
    size_of = n[left]
    second = np.searchsorted(left, cut) if other is not None else 0
    root = np.arange(len(left))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    out = []
    for i in range(second if other is not None else len(left) - 1):
        mine = code[places[i]:places[i + 1]]
        mine = mine[size[mine] > 1]
        count = size[mine]
        at = np.repeat(edge[mine] - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))
        inter = np.bincount(holder[at], minlength=len(left))
        inter[:max(second, i + 1)] = 0
        for j in np.flatnonzero((inter > 0) & (100 * inter >= SIMILAR * (size_of + size_of[i] - inter))).tolist():
            a, b = find(i), find(j)
            if a != b:
                root[max(a, b)] = min(a, b)
                out.append((int(left[i]), int(left[j])))
    return out


def planes(tokens: np.ndarray) -> bytes:
    """A sorted set as the byte planes of its differences: the high planes are nearly all zeros, which the
    shuffle's compression takes away."""
    return np.diff(tokens, prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8).T.tobytes()


def from_planes(data: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(data, np.uint8).reshape(8, -1).T.copy().view(np.uint64).ravel(), dtype=np.uint64)


def homes(places: DataFrame, need: DataFrame) -> DataFrame:
    """(hi, lo, node, home, part, own, away) of ``places(node, g, h, first)``: where a member's set goes.

    Of a pair of groups the one with more pairs is the home. Its members (``own``) are sent once for all of
    its pairs (``away``: the other groups), those of the other group once to each home. A home whose other groups
    hold more than ``ROOM`` tokens has several parts; a group is whole in one. A group is its own away group
    where it qualifies with itself."""
    pairs = places.where("g <> h").select("g", "h").distinct()
    degree = pairs.select(F.explode(F.array("g", "h")).alias("group")).groupBy("group").agg(
        F.count(F.lit(1)).alias("pairs"))
    sided = (pairs.join(degree.select(F.col("group").alias("g"), F.col("pairs").alias("of_g")), "g")
             .join(degree.select(F.col("group").alias("h"), F.col("pairs").alias("of_h")), "h")
             .select("g", "h", F.when(F.col("of_g") >= F.col("of_h"), F.col("g")).otherwise(F.col("h")).alias("home")))
    sent = (places.join(need.select("node", "hi", "lo", "n"), "node").join(sided, ["g", "h"], "left")
            .withColumn("home", F.coalesce("home", "g"))
            .withColumn("own", F.when(F.col("first"), F.col("g")).otherwise(F.col("h")) == F.col("home"))
            .withColumn("away", F.when(F.col("home") == F.col("g"), F.col("h")).otherwise(F.col("g"))))
    parts = sent.where(~F.col("own")).groupBy("home").agg(F.ceil(F.sum("n") / ROOM).alias("parts"))
    return (sent.join(parts, "home", "left")
            .withColumn("part", F.pmod(F.xxhash64("away"), F.coalesce("parts", F.lit(1))))
            .groupBy("hi", "lo", "node", "home", "part", "own").agg(F.collect_set("away").alias("away")))


def home_links(table: pa.Table) -> pa.Table:
    """(a, b): spanning links of a home's members with those of each of its other groups (one part of them)."""
    node = table.column("node").to_numpy()
    home = table.column("home")[0].as_py()
    sets = [from_planes(t) for t in table.column("tokens").to_pylist()]
    own, away = _sides(table)
    a, b = [], []
    for g, mine in own.items():
        theirs = away.get(g, [])
        both = mine + theirs
        if len(both) > 1 and (theirs or g == home):
            for i, j in opened_links([sets[k] for k in mine], [sets[k] for k in theirs] if g != home else None):
                a.append(int(node[both[i]]))
                b.append(int(node[both[j]]))
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def home_near(table: pa.Table) -> pa.Table:
    """The rows of a home (one part) that may be in a link, each with those of its ``away`` groups where it may."""
    n = table.column("n").to_numpy()
    home = table.column("home")[0].as_py()
    sketches = table.column("sketch").to_pylist()
    own, away = _sides(table)
    left = [[] for _ in sketches]
    for g, mine in own.items():
        theirs = away.get(g, []) if g != home else mine
        if theirs:
            some, met = near([sketches[k] for k in mine], n[mine],
                             [sketches[k] for k in theirs] if g != home else None, n[theirs])
            for k, stays in zip(mine + (theirs if g != home else []), [*some, *(met if g != home else [])]):
                if stays:
                    left[k].append(g)
    rows = np.flatnonzero([bool(x) for x in left])
    return pa.table({"away" if c == "away" else c: pa.array([left[k] for k in rows], pa.list_(pa.int64()))
                     if c == "away" else table.column(c).take(pa.array(rows))
                     for c in ("hi", "lo", "node", "home", "part", "own", "away")})


def _sides(table: pa.Table) -> tuple[dict, dict]:
    """Row numbers of a home's own members and of the others, by away group."""
    own, away = {}, {}
    for k, (mine, groups) in enumerate(zip(table.column("own").to_pylist(), table.column("away").to_pylist())):
        for g in groups:
            (own if mine else away).setdefault(g, []).append(k)
    return own, away


def opened(docs: DataFrame, text: str, members: DataFrame, sketches: DataFrame, places: DataFrame) -> DataFrame:
    """(a, b): spanning links of the members that ``places(node, g, h, first)`` opens for each pair of groups
    (g = h: inside one; ``first``: the member is in g). ``sketches(node, n, sketch)``: of all members."""
    spark = docs.sparkSession
    # the small rows meet first: a set is moved once to its name and once to each of its homes
    need = members.join(places.select("node").distinct(), "node", "left_semi")
    meet = homes(places, need).join(sketches, "node").groupBy("home", "part").applyInArrow(
        home_near, "hi long, lo long, node long, home long, part long, own boolean, away array<long>")
    goes = written(meet, "opened-homes")
    need = written(members.join(goes.select("node").distinct(), "node", "left_semi").select("tie"), "opened-members")
    ties = spark.sparkContext.broadcast(bitmap(need, "tie"))           # fixed size
    texts = docs.select(F.xxhash64(text).alias("tie"), F.col(text).alias("text")).where(F.col(text).isNotNull())

    def fitting(part):
        tie, first = np.unique(part.column("tie").to_numpy(), return_index=True)
        return first[passes(ties.value, tie.view(np.uint64))]

    def rows(batches):
        for _, sets in _set_rows(batches, fitting):
            some = {identity(s): s for s in sets if len(s)}
            yield pa.RecordBatch.from_pydict({
                "hi": pa.array([h for h, _ in some], pa.int64()), "lo": pa.array([x for _, x in some], pa.int64()),
                "tokens": pa.array([planes(s) for s in some.values()], pa.binary())})

    sets = texts.mapInArrow(rows, "hi long, lo long, tokens binary").dropDuplicates(["hi", "lo"])
    dealt = sets.join(goes, ["hi", "lo"]).select("home", "part", "own", "away", "node", "tokens")
    return dealt.groupBy("home", "part").applyInArrow(home_links, "a long, b long")


def _release(spark) -> None:
    """Let Spark drop the shuffle files of finished stages now: it does so when the driver collects its garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def jaccard_components(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of ``docs``.

    ``component_id`` is the smallest doc_id that a document is connected with by links, itself
    included. Null texts and texts without words have no token and are linked with nothing. A null
    doc_id counts as larger than any other (a component of null doc_ids alone has a null id). Rows that
    repeat a doc_id get a row each; an empty table gives none. Other columns are ignored.
    """
    spark = docs.sparkSession
    own = written(documents(docs, text, doc_id), "tgm-documents")
    nodes = own.where("hi is not null").groupBy("hi", "lo").agg(
        F.min("doc_id").alias("least_id"), F.min("tie").alias("tie"), F.max("n").alias("n"), F.first("low").alias("low"),
        F.first("sketch").alias("sketch"))
    nodes = written(nodes.withColumn("node", F.monotonically_increasing_id()), "tgm-nodes")
    kept = nodes.select(F.explode("low").alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("nodes"))
    kept = written(kept.where(F.col("nodes") > 1), "tgm-kept")
    frequent = spark.sparkContext.broadcast(bitmap(kept.where(F.col("nodes") >= SHARED), "token"))     # fixed size
    members = written(grouped(nodes, kept), "tgm-groups")
    first = prefixes(docs, text, frequent).groupBy("hi", "lo").agg(F.first("prefix").alias("prefix"))
    _release(spark)
    tokens = written(shared_tokens(first.join(members.drop("tie"), ["hi", "lo"])), "tgm-tokens")
    _release(spark)
    found = written(qualifying(written(matrix(tokens), "tgm-matrix")), "tgm-qualifying")
    # a member can only be in a link of a qualifying pair of which it holds an entry
    held = found.select("token", "g", "h", F.explode(F.array_distinct(F.array("g", "h"))).alias("group"))
    places = written(tokens.join(held, ["token", "group"]).select(
        "node", "g", "h", (F.col("group") == F.col("g")).alias("first")).distinct(), "tgm-places")
    _release(spark)
    links = written(opened(docs, text, members, nodes.select("node", "n", "sketch"), places), "tgm-links")
    _release(spark)
    found = components(links)
    home = nodes.join(found, "node", "left").select("hi", "lo", "least_id", F.coalesce("component", "node").alias("component"))
    ids = home.groupBy("component").agg(F.min("least_id").alias("component_id"))
    home = home.join(ids, "component").select("hi", "lo", "component_id")
    return own.drop("low", "tie", "sketch").join(home, ["hi", "lo"], "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("hi").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))
