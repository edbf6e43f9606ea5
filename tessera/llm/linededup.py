"""Line dedup: three-line windows that occurred before are removed, by built-in functions only.

A window is three consecutive non-blank lines of a document (compared after trimming spaces, tabs
and carriage returns); a document with fewer has none and stays whole. Windows are compared by a
128-bit hash. In the order (doc_id, hash of the text, line) the first occurrence of a window stays;
every later one is removed. The lines that removed windows cover are merged into runs, and the runs
are cut out of the document; blank lines right after a run go with it.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tessera.llm.common import fresh, written

WINDOW = 3


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _solid(lines: Column) -> Column:
    """(line number, hash) of the non-blank lines."""
    numbered = F.transform(lines, lambda x, i: F.struct(
        i.alias("i"), F.btrim(x, F.lit(" \t\r")).alias("s")))
    return F.transform(F.filter(numbered, lambda x: x["s"] != ""),
                       lambda x: F.struct(x["i"].alias("i"), F.xxhash64(x["s"]).alias("h")))


def window_occurrences(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, tie, k, w1, w2): window k of every document; ``tie`` is the hash of its text."""
    solid = docs.where(F.col(text).isNotNull()).select(
        F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("tie"), _solid(_lines(F.col(text))).alias("l"))
    at = lambda k, j: F.get("l", k + j)["h"]
    windows = F.when(F.size("l") >= WINDOW, F.transform(
        F.sequence(F.lit(0), F.size("l") - WINDOW), lambda k: F.struct(
            k.alias("k"), F.xxhash64(at(k, 0), at(k, 1), at(k, 2)).alias("w1"),
            F.xxhash64(F.lit(7), at(k, 2), at(k, 0), at(k, 1)).alias("w2"))))
    return solid.select("doc_id", "tie", F.inline(windows))


def repeated_windows(occurrences: DataFrame) -> DataFrame:
    """(w1, w2, first): windows with more than one place, and the first place.

    Rows that agree in doc_id and text are one document here: they lose the same lines.
    """
    place = F.struct("doc_id", "tie", "k")
    return (occurrences.groupBy("w1", "w2").agg(F.min(place).alias("first"), F.max(place).alias("last"))
            .where(~F.col("first").eqNullSafe(F.col("last"))).drop("last"))


def removed_windows(occurrences: DataFrame) -> DataFrame:
    """(doc_id, tie, ks): sorted window numbers to remove of every document that loses some."""
    # A stored table, so that both join sides are plain shuffles and a hot window can be split.
    repeated = written(repeated_windows(occurrences), "repeated-windows")
    later = occurrences.join(repeated, ["w1", "w2"]).where(
        ~F.struct("doc_id", "tie", "k").eqNullSafe(F.col("first")))
    return later.groupBy("doc_id", "tie").agg(F.sort_array(F.collect_set("k")).alias("ks"))


def dedup_lines(docs: DataFrame, text: str = "text", doc_id: str = "doc_id",
                names: tuple[str, str, str] = ("n_lines", "n_removed", "removed")) -> DataFrame:
    """``docs`` with repeated passages cut out of ``text``, plus the number of lines, of removed
    lines, and the removed runs ``[first, last)`` of line numbers.

    Null texts stay null with 0 lines; empty texts have one (blank) line. Other columns are kept;
    columns that clash with ``names`` are replaced.
    """
    n_lines, n_removed, runs = names
    base = docs.drop(*[n for n in names if n in docs.columns])
    tie, lines, solid, g_id, g_tie, g_ks = (
        fresh(docs, c) for c in ("_tie", "_lines", "_solid", "_gone_id", "_gone_tie", "_gone_ks"))
    gone = removed_windows(window_occurrences(base, text, doc_id)).select(
        F.col("doc_id").alias(g_id), F.col("tie").alias(g_tie), F.col("ks").alias(g_ks))
    joined = base.withColumn(tie, F.xxhash64(text)).join(
        gone, F.col(doc_id).eqNullSafe(F.col(g_id)) & (F.col(tie) == F.col(g_tie)), "left")
    ks = F.col(g_ks)
    starts = F.filter(ks, lambda k, i: (i == 0) | (k > F.get(ks, i - 1) + WINDOW))
    ends = F.filter(ks, lambda k, i: (i == F.size(ks) - 1) | (F.get(ks, i + 1) > k + WINDOW))
    split = joined.withColumn(lines, _lines(F.col(text)))
    merged = split.withColumn(solid, F.when(ks.isNotNull(), _solid(F.col(lines)))).withColumn(
        runs, F.coalesce(F.transform(F.arrays_zip(starts.alias("a"), ends.alias("b")), lambda r: F.struct(
            F.get(F.col(solid), r["a"])["i"].alias("first"),
            F.coalesce(F.get(F.col(solid), r["b"] + WINDOW)["i"], F.size(F.col(lines))).alias("last"))),
            F.array().cast("array<struct<first:int,last:int>>")))
    edges = F.concat(F.array(F.lit(0)), F.col(f"{runs}.last"))
    stops = F.concat(F.col(f"{runs}.first"), F.array(F.size(F.col(lines))))
    kept = F.flatten(F.transform(F.arrays_zip(edges.alias("a"), stops.alias("b")),
                                 lambda r: F.slice(F.col(lines), r["a"] + 1, r["b"] - r["a"])))
    out = merged.withColumn(text, F.when(ks.isNull(), F.col(text)).otherwise(F.array_join(kept, "\n")))
    return (out.withColumn(n_lines, F.when(F.col(lines).isNull(), 0).otherwise(F.size(F.col(lines))))
            .withColumn(n_removed, F.aggregate(F.col(runs), F.lit(0), lambda s, r: s + r["last"] - r["first"]))
            .select(*base.columns, *names))


#: DuckDB SQL for the query op5 over unique doc_ids (windows compared by their lines themselves).
ORACLE = """
WITH d AS (SELECT doc_id, text, string_split(text, chr(10)) AS ls FROM documents),
raw AS (SELECT doc_id, generate_subscripts(ls, 1) - 1 AS i, unnest(ls) AS line FROM d WHERE text IS NOT NULL),
l AS (SELECT doc_id, i, line, trim(line, ' ' || chr(9) || chr(13)) AS s FROM raw),
nb AS (SELECT doc_id, i, s, row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1 AS k FROM l WHERE s <> ''),
w AS (SELECT doc_id, k, s AS a, lead(s, 1) OVER v AS b, lead(s, 2) OVER v AS c
      FROM nb WINDOW v AS (PARTITION BY doc_id ORDER BY k)),
r AS (SELECT doc_id, k, row_number() OVER (PARTITION BY a, b, c ORDER BY doc_id, k) AS n FROM w WHERE c IS NOT NULL),
cov AS (SELECT DISTINCT doc_id, k + j AS k FROM r, (SELECT unnest([0, 1, 2]) AS j) WHERE n > 1),
gone AS (SELECT nb.doc_id, nb.i, cov.k IS NOT NULL AS g FROM nb LEFT JOIN cov ON nb.doc_id = cov.doc_id AND nb.k = cov.k),
st AS (SELECT l.doc_id, l.i, l.line, coalesce(last_value(gone.g IGNORE NULLS) OVER
         (PARTITION BY l.doc_id ORDER BY l.i ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), false) AS g
       FROM l LEFT JOIN gone ON l.doc_id = gone.doc_id AND l.i = gone.i),
agg AS (SELECT doc_id, count(*)::INTEGER AS n_lines, (count(*) FILTER (g))::INTEGER AS n_removed,
               coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT g), '') AS kept FROM st GROUP BY doc_id)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE agg.kept END AS text,
       coalesce(agg.n_lines, 0) AS n_lines, coalesce(agg.n_removed, 0) AS n_removed
FROM d LEFT JOIN agg ON d.doc_id = agg.doc_id
"""
