"""Source divergence audit by chunk factorization: which sources of a language use other words, and which.

1. Chunks. A scan counts every document's white-space chunks (A-Z lower-cased, without marks and digits
   at either end, which belong to no term) and sums them over a slice of documents, per (lang, source):
   occurrences, documents, first and last document. A document lies in one slice: documents add up.
2. Terms. Every globally distinct chunk is cut into terms once; the terms meet the chunk's counts in
   the chunk's row, whose size is bounded by the number of (lang, source) groups. Occurrences of a term
   are sums over its chunks.
3. Distinct documents. Sources share no document, so a term is in at least the sum over the sources of
   its commonest chunk's documents, and at most in the sum over all its chunks. Where ``min_docs`` lies
   between the two, the documents themselves are counted: of a chunk in one or two documents the first
   and the last are all; for a larger ``min_docs`` a second scan lists them.
4. Divergence of all pairs of sources of a language. Terms are dealt into blocks, sources into blocks
   of ``SOURCES``; a task holds the counts of one term block in two source blocks and sums the exact
   integer terms of every pair in it. Terms absent from both sources are added as one constant.

All arithmetic is exact: probabilities are integers of parts in 10 ** 9, products are decimals. Groups
are told apart by a 64-bit hash of (lang, source).

Null text, lang and source count as ''. Every row is a document of its own, also a repeated one; doc_id
is not read. Groups without any term take part with zero counts. An empty table gives no rows. Other
columns are ignored. Rows are numbered in place: ``docs`` should be a stored table (a file scan).
"""
from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tessera.llm import textvec as tv
from tessera.llm.common import written

TERM = "([^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+)"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SLICE = 4 << 20             # bytes of text in a slice
PARTS = 1_000_000_000
SOURCES = 256               # sources in a block
CELLS = 1 << 20             # counts in a term block, about
TERMS = 1 << 12             # terms of one matrix in a task

IN_TERM = np.zeros(256, bool)
IN_TERM[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
CHUNKS = "lang string, gid long, chunk string, n long, n_docs long, first long, last long"


def _chunk_strings(data: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """(all white-space chunks of a slice that hold a term, from its first to its last term byte, A-Z
    lower-cased; the text each one is in)."""
    rel = offsets - offsets[0]
    raw = tv.LOWER[data[int(offsets[0]):int(offsets[-1])]]
    solid = ~tv.IS_SPACE[raw]
    edge = np.zeros(len(raw) + 1, bool)
    edge[rel] = True
    before = np.ones(len(raw), bool)
    before[1:] = ~solid[:-1] | edge[1:len(raw)]
    after = np.ones(len(raw), bool)
    after[:-1] = ~solid[1:] | edge[1:len(raw)]
    number = np.concatenate([[0], np.cumsum(IN_TERM[raw], dtype=np.int32)])         # term bytes before each place
    lo, hi = number[:-1][solid & before], number[1:][solid & after]                 # ... before and in each chunk
    inside = np.flatnonzero(IN_TERM[raw])
    first, last = inside[lo[hi > lo]], inside[hi[hi > lo] - 1]
    inner = np.zeros(len(raw) + 1, np.int8)
    inner[first] += 1
    inner[last + 1] -= 1
    kept = raw[np.cumsum(inner[:-1], dtype=np.int8).view(bool)]
    ends = np.concatenate([[0], np.cumsum(last + 1 - first)]).astype(np.int64)
    chunks = pa.LargeStringArray.from_buffers(len(first), pa.py_buffer(ends), pa.py_buffer(kept))
    return chunks, np.searchsorted(rel, first, side="right") - 1


def _runs(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order that sorts by the keys, first of each run of equal keys in it)."""
    order = np.lexsort(keys[::-1])
    new = np.ones(len(order), bool)
    if len(order):
        new[1:] = np.any([k[order][1:] != k[order][:-1] for k in keys], axis=0)
    return order, np.flatnonzero(new)


def named(docs: DataFrame) -> DataFrame:
    """(text, lang, source, gid) without nulls."""
    return docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("text", "lang", "source")]
                       ).withColumn("gid", F.xxhash64("lang", "source"))


def chunk_counts(docs: DataFrame, every_document: bool = False) -> DataFrame:
    """(lang, gid, chunk, n, n_docs, first, last) of every slice of ``named`` documents: occurrences and
    documents of a chunk, the first and the last document. With ``every_document`` a row for each."""

    def rows(batches):
        from pyspark import TaskContext
        number = TaskContext.get().partitionId() << 40
        for batch in batches:
            for part in tv.bounded_slices(batch, "text", SLICE):
                number += part.num_rows
                chunks, doc = _chunk_strings(*tv.utf8(part.column("text")))
                if not len(chunks):
                    continue
                coded = chunks.dictionary_encode()
                code = coded.indices.to_numpy().astype(np.int64)
                gids, at, gid = np.unique(part.column("gid").to_numpy(), return_index=True, return_inverse=True)
                # chunks per document, then per group of the slice
                key = gid[doc] * len(coded.dictionary) + code
                order, first = _runs(key, doc)
                times = np.diff(np.append(first, len(order)))
                key, doc = key[order][first], doc[order][first]
                at_key = np.arange(len(key)) if every_document else np.flatnonzero(np.append(True, key[1:] != key[:-1]))
                n_docs = np.diff(np.append(at_key, len(key)))
                group, code = np.divmod(key[at_key], len(coded.dictionary))
                yield pa.RecordBatch.from_pydict({
                    "lang": part.column("lang").take(pa.array(at[group])), "gid": pa.array(gids[group]),
                    "chunk": coded.dictionary.take(pa.array(code)).cast(pa.string()),
                    "n": pa.array(np.add.reduceat(times, at_key), pa.int64()),
                    "n_docs": pa.array(n_docs, pa.int64()),
                    "first": pa.array(number - part.num_rows + doc[at_key], pa.int64()),
                    "last": pa.array(number - part.num_rows + doc[at_key + n_docs - 1], pa.int64())})

    return docs.select("text", "lang", "gid").mapInArrow(rows, CHUNKS)


def terms_of(chunks: DataFrame) -> DataFrame:
    """``chunks`` with (term, times) for every distinct term of each chunk."""
    found = F.regexp_extract_all("chunk", F.lit(TERM), F.lit(1))
    times = F.expr("size(filter(_found, x -> x = term))").cast("long")
    alone = F.when(F.size("_found") == 1, F.lit(1).cast("long")).otherwise(times)
    return (chunks.withColumn("_found", found).withColumn("term", F.explode(F.array_distinct("_found")))
            .withColumn("times", alone).drop("_found"))


def term_counts(docs: DataFrame, min_docs: int = 3) -> DataFrame:
    """(lang, gid, term, n): occurrences of the terms in at least ``min_docs`` documents of the lang, in
    ``named`` documents."""
    chunks = written(chunk_counts(docs).groupBy("lang", "gid", "chunk").agg(
        F.sum("n").alias("n"), F.sum("n_docs").alias("n_docs"), F.min("first").alias("first"),
        F.max("last").alias("last")), "chunks")
    own = F.collect_list(F.struct("lang", "gid", "n", "n_docs")).alias("own")      # one of each group at most
    back = terms_of(chunks.groupBy("chunk").agg(own)).select("term", "times", F.inline("own"))
    found = (back.repartition("lang", "term").groupBy("lang", "term", "gid")
             .agg(F.sum(F.col("n") * F.col("times")).alias("n"), F.max("n_docs").alias("least"), F.sum("n_docs").alias("most")))
    term = W.partitionBy("lang", "term")
    found = written(found.withColumn("least", F.sum("least").over(term)).withColumn("most", F.sum("most").over(term))
                    .where(F.col("most") >= min_docs), "terms")
    # several chunks, each in few documents: their documents are counted
    open_ = found.where(F.col("least") < min_docs).select("lang", "term").distinct()
    named_in = terms_of(chunks).join(open_, ["lang", "term"], "left_semi").select("lang", "gid", "chunk", "term", "first", "last")
    if min_docs <= 3:
        listed = named_in.select("lang", "term", F.explode(F.array("first", "last")).alias("doc"))
    else:
        every = chunk_counts(docs, every_document=True).select("lang", "gid", "chunk", F.col("first").alias("doc"))
        listed = named_in.drop("first", "last").join(every, ["lang", "gid", "chunk"]).select("lang", "term", "doc")
    enough = (listed.distinct().groupBy("lang", "term").agg(F.count(F.lit(1)).alias("n_docs"))
              .where(F.col("n_docs") >= min_docs).select("lang", "term"))
    kept = found.where(F.col("least") >= min_docs).unionByName(
        found.where(F.col("least") < min_docs).join(enough, ["lang", "term"], "left_semi"))
    return written(kept.select("lang", "gid", "term", "n"), "term-counts")


def _share(n: str, total: str, terms: str) -> Column:
    """1 + floor(10^9 (n + 1) / (total + terms)), exact."""
    return F.expr(f"1 + (cast({PARTS} as decimal(10,0)) * cast(coalesce({n}, 0) + 1 as decimal(19,0))) "
                  f"div cast({total} + {terms} as decimal(20,0))")


def _gain(p: str, q: str) -> Column:
    return F.expr(f"(({p}) - ({q})) * (({p}) - ({q})) div ({q})")


def _block_sums(batch: pd.DataFrame, bi: int, bj: int):
    """Sums over one term block for every ordered pair of sources of two source blocks: (source index,
    other index, sum, terms seen). Rows without a term carry the sources' sizes."""
    heads = batch[batch["term"].isna()].drop_duplicates("gid")
    cells = batch[batch["term"].notna()]
    names = heads["gid"].to_numpy()
    own = heads["block"].to_numpy()
    total = (heads["total"] + heads["terms"]).to_numpy(np.int64)
    at = pd.Index(names).get_indexer(cells["gid"])
    code, seen = pd.factorize(cells["term"])
    n = cells["n"].to_numpy(np.int64)
    order = np.argsort(code, kind="stable")
    code, at, n = code[order], at[order], n[order]
    empty = 1 + PARTS // np.maximum(total, 1)
    # parts of 10^9 (n + 1) / total without overflow: whole and rest separately
    whole, rest = np.divmod(n + 1, np.maximum(total[at], 1))
    if len(n) and rest.max() >= 2 ** 63 // PARTS:
        share = np.array([1 + PARTS * (int(a) + 1) // int(t) for a, t in zip(n, total[at])], np.int64)
    else:
        share = 1 + whole * PARTS + rest * PARTS // np.maximum(total[at], 1)
    rows_i = np.flatnonzero(own == bi)
    rows_j = np.flatnonzero(own == bj)
    sums = np.zeros((len(names), len(names)), np.int64)
    for lo in range(0, len(seen), TERMS):
        a, b = np.searchsorted(code, [lo, lo + TERMS])
        p = np.repeat(empty[:, None], min(TERMS, len(seen) - lo), axis=1)
        p[at[a:b], code[a:b] - lo] = share[a:b]
        for g, others in [(g, rows_j) for g in rows_i] + ([(g, rows_i) for g in rows_j] if bi != bj else []):
            q = p[others]
            d = p[g] - q
            sums[g, others] += (d * d // q).sum(1)
    i, j = np.nonzero((own[:, None] != own[None, :]) if bi != bj else ~np.eye(len(names), dtype=bool))
    return names[i], names[j], sums[i, j], np.full(len(i), len(seen))


def pair_values(counts: DataFrame, groups: DataFrame) -> DataFrame:
    """(gid, other, value): divergence of every source from every other one of its lang.

    ``counts(lang, gid, term, n)`` holds kept terms, ``groups(lang, gid, total, terms)`` every group with
    its occurrences of kept terms and its lang's number of kept terms.
    """
    size = groups.groupBy("lang").agg(F.count(F.lit(1)).alias("_sources"))
    cells = counts.groupBy("lang").agg(F.count(F.lit(1)).alias("_cells"))
    shape = size.join(cells, "lang", "left").select(
        "lang", F.ceil(F.col("_sources") / SOURCES).cast("int").alias("_s"),
        F.greatest(F.lit(1), F.ceil(F.coalesce("_cells", F.lit(0)) / CELLS)).cast("int").alias("_t"))
    block = F.pmod(F.xxhash64("gid"), F.col("_s")).cast("int").alias("block")
    none = F.lit(None)
    heads = groups.join(shape, "lang").select(
        "lang", "gid", none.cast("string").alias("term"), none.cast("long").alias("n"), "total", "terms",
        block, "_s", F.explode(F.sequence(F.lit(0), F.col("_t") - 1)).alias("tb"))
    filled = counts.join(shape, "lang").select(
        "lang", "gid", "term", "n", none.cast("long").alias("total"), none.cast("long").alias("terms"),
        block, "_s", F.pmod(F.xxhash64("term"), F.col("_t")).cast("int").alias("tb"))
    dealt = heads.unionByName(filled).withColumn("_o", F.explode(F.sequence(F.lit(0), F.col("_s") - 1))).select(
        "lang", "tb", F.least("block", "_o").alias("bi"), F.greatest("block", "_o").alias("bj"),
        "gid", "block", "term", "n", "total", "terms")

    def sums(key, pdf):
        g, h, s, seen = _block_sums(pdf, key[2], key[3])
        return pd.DataFrame({"gid": g, "other": h, "part": s, "seen": seen})

    parts = dealt.groupBy("lang", "tb", "bi", "bj").applyInPandas(sums, "gid long, other long, part long, seen long")
    both = parts.groupBy("gid", "other").agg(F.sum("part").alias("part"), F.sum("seen").alias("seen"))
    nothing = groups.select("gid", "terms", F.when(F.col("terms") > 0, _share("0", "total", "terms")).alias("p"))
    other = nothing.select(F.col("gid").alias("other"), F.col("p").alias("q"))
    rest = F.when(F.col("terms") > 0, (F.col("terms") - F.col("seen")) * _gain("p", "q")).otherwise(0)
    return both.join(nothing, "gid").join(other, "other").select(
        "gid", "other", (F.col("part") + rest).alias("value"))


def audit(docs: DataFrame, min_docs: int = 3, top_terms: int = 200) -> DataFrame:
    """(lang, source, part, item, value, rank): part ``pair`` ranks the other sources of the lang by
    divergence, part ``term`` the ``top_terms`` terms that the source uses more than its lang does."""
    docs = named(docs)
    counts = term_counts(docs, min_docs)
    in_lang = written(counts.groupBy("lang", "term").agg(F.sum("n").alias("n_lang")), "lang-terms")
    langs = in_lang.groupBy("lang").agg(F.sum("n_lang").alias("all_n"), F.count(F.lit(1)).alias("all_terms"))
    totals = counts.groupBy("gid").agg(F.sum("n").alias("sum_n"))
    groups = docs.select("lang", "source", "gid").distinct().join(totals, "gid", "left").join(langs, "lang", "left")
    groups = written(groups.select(
        "lang", "source", "gid", F.coalesce("sum_n", F.lit(0)).alias("total"),
        F.coalesce("all_terms", F.lit(0)).alias("terms"), F.coalesce("all_n", F.lit(0)).alias("all_n")), "groups")
    order = W.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    rank = F.row_number().over(order)
    out = ["lang", "source", "part", "item", "value", "rank"]
    name = groups.select("gid", "lang", "source")
    pairs = (pair_values(counts, groups.drop("all_n", "source"))
             .join(name, "gid").join(name.select(F.col("gid").alias("other"), F.col("source").alias("item")), "other")
             .withColumn("part", F.lit("pair")).withColumn("rank", rank))
    words = (counts.join(in_lang, ["lang", "term"]).join(groups.drop("lang"), "gid")
             .withColumn("p", _share("n", "total", "terms")).withColumn("q", _share("n_lang", "all_n", "terms"))
             .where(F.col("p") > F.col("q"))
             .select("lang", "source", F.col("term").alias("item"), _gain("p", "q").alias("value")))
    best = words.withColumn("rank", rank).where(F.col("rank") <= top_terms).withColumn("part", F.lit("term"))
    return pairs.select(*out).unionByName(best.select(*out))


#: The same rows in DuckDB SQL.
ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS doc, coalesce(text, '') AS text, coalesce(lang, '') AS lang,
                  coalesce(source, '') AS source FROM documents),
t AS (SELECT doc, lang, source, translate(unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term FROM d),
kept AS (SELECT lang, term, count(*)::HUGEINT AS n FROM t GROUP BY lang, term HAVING count(DISTINCT doc) >= 3),
lv AS (SELECT lang, sum(n)::HUGEINT AS total, count(*)::HUGEINT AS v FROM kept GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT t.lang, t.source, t.term, count(*)::HUGEINT AS n FROM t JOIN kept USING (lang, term) GROUP BY ALL),
gn AS (SELECT lang, source, sum(n)::HUGEINT AS total FROM c GROUP BY ALL),
p AS (SELECT g.lang, g.source, kept.term, coalesce(c.n, 0) AS n,
             1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 1)) // (coalesce(gn.total, 0) + lv.v) AS p,
             1 + (1000000000::HUGEINT * (kept.n + 1)) // (lv.total + lv.v) AS q
      FROM g JOIN kept ON kept.lang = g.lang JOIN lv ON lv.lang = g.lang
      LEFT JOIN gn ON gn.lang = g.lang AND gn.source = g.source
      LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = kept.term),
pair AS (SELECT a.lang, a.source, b.source AS item FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source),
pv AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p)::BIGINT AS value
       FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pr AS (SELECT pair.lang, pair.source, 'pair' AS part, pair.item, coalesce(pv.value, 0) AS value
       FROM pair LEFT JOIN pv ON pv.lang = pair.lang AND pv.source = pair.source AND pv.item = pair.item),
tr AS (SELECT lang, source, 'term' AS part, term AS item, ((p - q) * (p - q) // q)::BIGINT AS value
       FROM p WHERE n > 0 AND p > q),
a AS (SELECT * FROM pr UNION ALL SELECT * FROM tr)
SELECT lang, source, part, item, value, rank::INTEGER AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM a)
WHERE part = 'pair' OR rank <= 200
"""
