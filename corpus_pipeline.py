"""The corpus pipeline: from raw documents to packed training sequences.

Every stage takes ``(spark, docs, sf_dir)`` and works on all documents that the stage before it
kept; all but the last return the columns of ``documents``. Each stage's result is written to the
shared folder and read back, so a lost executor costs one stage at most.

1. ``language_id``: documents without a determined language (null text, no letter) go.
2. ``line_dedup``: three-line windows that occurred before are cut out of the texts (``n_chars``
   follows); a document of which nothing is left goes. Empty documents that lost nothing stay.
3. ``near_dedup``: one document of each near-duplicate group stays, the one with the smallest doc_id.
4. ``decontamination``: documents that hold a benchmark item, exact or edited, go.
5. ``packing``: all that is left is tokenised and packed; one row per piece.

Nulls in other columns are carried along; repeated rows are one document from stage 3 on.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tessera.llm import decontam, langid, linededup, neardup, packing
from tessera.llm.common import fresh, table, written
from tessera.session import read_table, ship_package


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    learn = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 != 2
    langs, weights = langid.fit(docs.select("doc_id", "text", "lang"), learn)
    names = (fresh(docs, "_lang"), fresh(docs, "_score"))
    found = langid.predict(docs, langs, weights, names=names)
    return found.where(F.col(names[0]) != langid.UNDETERMINED).select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    names = tuple(fresh(docs, n) for n in ("_n_lines", "_n_removed", "_removed"))
    cut = linededup.dedup_lines(docs, names=names)
    changed = F.col(names[1]) > 0
    left = cut.where(~changed | (F.btrim("text", F.lit(" \t\r\n")) != ""))
    if "n_chars" in docs.columns:
        length = F.char_length("text").cast(docs.schema["n_chars"].dataType)
        left = left.withColumn("n_chars", F.when(changed, length).otherwise(F.col("n_chars")))
    return left.select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return neardup.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.clean(docs, table(spark, sf_dir, "benchmark", "item_id", "text"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs.select("doc_id", "text"))


STAGES = [("language_id", language_id), ("line_dedup", line_dedup), ("near_dedup", near_dedup),
          ("decontamination", decontamination), ("packing", pack)]

#: Language ID, near-dedup, alignment and tokenising have no SQL form; tests/llm/test_pipeline.py
#: holds the stages against brute-force versions instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``: the rows of the last one."""
    ship_package(spark)
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
