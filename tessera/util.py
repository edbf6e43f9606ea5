"""Small shared helpers."""
from __future__ import annotations

from pyspark.sql import Column, functions as F


def as_col(c) -> Column:
    """Column passthrough; strings are column names; other Python values become literals."""
    if isinstance(c, Column):
        return c
    if isinstance(c, str):
        return F.col(c)
    return F.lit(c)


def lit_or_col(v) -> Column:
    """Strings are literals here (for parameters such as dates and labels)."""
    return v if isinstance(v, Column) else F.lit(v)
