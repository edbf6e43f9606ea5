"""Registered queries of the training-data operators (production parameters, whole tables)."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tessera.llm import align, dac, decontam, divergence, htmltext, langid, linededup, neardup, packing, sharding, tgm, topk, toxicity
from tessera.llm.common import table, text_or_empty
from tessera.session import scratch_dir

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pack every document into sequences of at most 2048 tokens."""
    return packing.pack(table(spark, sf_dir, "documents", "doc_id", "text"))


@query
def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deal every document to one of 40 shards; the law is ``rows`` (bounded load 1.0)."""
    digest = table(spark, sf_dir, "documents", "doc_id", "text").select(
        "doc_id", (F.octet_length(text_or_empty("text")) + 16).cast("long").alias("size"),
        F.crc32(text_or_empty("text")).alias("text_crc32"), F.lit("rows").alias("law"))
    placed = sharding.shard(digest, "doc_id", shards=40, order=("doc_id", "text_crc32", "size"))
    return placed.withColumn("grown_shard", F.lit(None).cast("int"))


def remainder(divisor: int):
    """crc32 of doc_id written as text, modulo ``divisor`` (a null doc_id has remainder null)."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % divisor


@query
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score every document; labels are learned only where the remainder modulo 5 is not 0."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    labels = table(spark, sf_dir, "labels", "doc_id", "toxic")
    weights, bias = toxicity.fit(toxicity.labelled_sample(docs, labels, remainder(5) != 0))
    return toxicity.score(docs, weights, bias, keep=("doc_id",)).select(
        "doc_id", F.coalesce(remainder(5) == 0, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query
def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predict every document's language; learned only where the remainder modulo 4 is not 2."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    langs, weights = langid.fit(docs, remainder(4) != 2)
    return langid.predict(docs.select("doc_id", "text"), langs, weights, keep=("doc_id",)).select(
        "doc_id", F.coalesce(remainder(4) == 2, F.lit(False)).alias("held_out"), "lang_pred", "score")


@query
def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write all documents' ids as directly addressable codes and read the files back."""
    path = scratch_dir(spark, "tokens")
    dac.write(table(spark, sf_dir, "documents", "doc_id", "text"), path)
    return dac.read_documents(spark, path)


@query
def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return htmltext.extract(table(spark, sf_dir, "pages", "page_id", "url", "html"), keep=("page_id", "url"))


@query
def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its repeated passages removed."""
    return linededup.dedup_lines(table(spark, sf_dir, "documents", "doc_id", "text")).drop("removed")


ORACLE["op5_line_dedup"] = linededup.ORACLE


@query
def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of a document and a benchmark item that it holds, exact or edited."""
    return decontam.leaks(table(spark, sf_dir, "documents", "doc_id", "text"),
                          table(spark, sf_dir, "benchmark", "item_id", "text")).drop("tie")


@query
def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate component of every document."""
    found = neardup.near_duplicates(table(spark, sf_dir, "documents", "doc_id", "text"))
    return found.select("doc_id", "n_shingles", "component_id", "kept")


@query
def op6_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 best other vectors of every vector whose id is divisible by 50."""
    return topk.top_k(table(spark, sf_dir, "embeddings", "vec_id", "embedding"), F.col("vec_id") % 50 == 0, k=5)


ORACLE["op6_exact_topk"] = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda e: floor(256 * e::DOUBLE)::BIGINT) AS x FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0),
c AS (SELECT vec_id, generate_subscripts(x, 1) AS i, unnest(x) AS x FROM v),
s AS (SELECT q.vec_id AS query_id, c.vec_id, sum(q.x * c.x)::BIGINT AS score
      FROM c q JOIN c ON q.i = c.i AND q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0 GROUP BY ALL)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 5
"""


@query
def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Divergence of every source from the others of its language, and its most typical terms."""
    return divergence.audit(table(spark, sf_dir, "documents", "text", "lang", "source"))


ORACLE["op13_source_divergence"] = divergence.ORACLE


@query
def op12_cross_tokenizer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alignment of the byte-level and the piece tokenizer on every document."""
    return align.aligned(table(spark, sf_dir, "documents", "doc_id", "text"))


@query
def op11_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of every document under links of 4-word shingle sets at 0.85."""
    return tgm.jaccard_components(table(spark, sf_dir, "documents", "doc_id", "text"))
