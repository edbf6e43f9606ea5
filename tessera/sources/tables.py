"""Expose bronze, the current manifest and the attempt log as SQL views.

Lets users query with ``spark.sql`` / ``spark.table`` as they would with catalog tables, e.g.
``SELECT group_id, max(obs_date), sum(row_count) FROM manifest GROUP BY group_id``.
"""
from __future__ import annotations

from pyspark.sql import SparkSession

from tessera.sinks.bronze import read_bronze
from tessera.sinks.manifest import read_current_manifest


def register_views(spark: SparkSession, *, bronze: str | None = None, manifest: str | None = None,
                   prefix: str = "") -> list[str]:
    """Create temp views ``{prefix}bronze`` and ``{prefix}manifest`` (current rows); returns
    their names."""
    names = []
    if bronze:
        read_bronze(spark, bronze).createOrReplaceTempView(f"{prefix}bronze")
        names.append(f"{prefix}bronze")
    if manifest:
        read_current_manifest(spark, manifest).createOrReplaceTempView(f"{prefix}manifest")
        names.append(f"{prefix}manifest")
    return names
