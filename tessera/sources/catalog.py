"""Group catalog snapshot and the materialised instrument catalog."""
from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F


def group_catalog(snapshot: DataFrame) -> DataFrame:
    """S4 + P16: ``group_id, group_name -> name, description`` from a catalog snapshot."""
    return snapshot.select("group_id", F.col("group_name").alias("name"), "description")


def dedupe_listing(listing: DataFrame, pos_col: str = "pos") -> DataFrame:
    """A live group listing -> one row per non-empty id, the first listed one wins.

    Missing values become ''. ``min_by`` in a sort-based aggregate (partial aggregation) instead of a
    window, so a repeated id is folded map-side.
    """
    clean = listing.select(
        F.coalesce(F.col("group_id").cast("string"), F.lit("")).alias("group_id"),
        F.coalesce(F.col("group_name").cast("string"), F.lit("")).alias("name"),
        F.coalesce(F.col("description").cast("string"), F.lit("")).alias("description"), pos_col)
    first = F.min_by(F.struct("name", "description"), F.col(pos_col)).alias("_f")
    return (clean.filter(F.col("group_id") != "").groupBy("group_id").agg(first)
            .select("group_id", "_f.name", "_f.description"))


def search_groups(groups: DataFrame, text: str) -> DataFrame:
    """Lower-cased group_id OR name matches the lower-cased filter (a regex, as in the
    source)."""
    if not text:
        return groups
    f = text.lower()
    return groups.filter(F.lower("group_id").rlike(f) | F.lower("name").rlike(f))


def list_groups(spark: SparkSession, snapshot_path: str | None, live_listing, text: str = "") -> DataFrame:
    """S4 as one call: the catalog snapshot if there is one, else the live listing (deduped, first
    listed wins), then the search filter. ``live_listing`` is a zero-argument callable returning
    ``group_id, group_name, description, pos``; it is only called without a snapshot."""
    if snapshot_path:
        try:
            return search_groups(group_catalog(spark.read.parquet(snapshot_path)), text)
        except AnalysisException as exc:
            if "PATH_NOT_FOUND" not in str(exc):
                raise
    return search_groups(dedupe_listing(live_listing()), text)


def cached_catalog(spark: SparkSession, path: str, build, *, refresh: bool = False) -> DataFrame:
    """Read the materialised catalog at ``path``; build and write it first when it is
    missing or ``refresh`` is set. ``build`` is a zero-argument callable returning a DataFrame."""
    if not refresh:
        try:
            return spark.read.parquet(path)
        except AnalysisException as exc:       # only a missing folder means "build it"
            if "PATH_NOT_FOUND" not in str(exc):
                raise
    build().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
