"""Text helpers."""
from __future__ import annotations

from pyspark.sql import Column, functions as F

from tessera.util import as_col, lit_or_col

# Python's str.strip() removes all ASCII whitespace; Spark's trim() only spaces.
_WHITESPACE = " \t\n\r\x0b\x0c"


def py_strip(c) -> Column:
    """``str.strip()`` semantics."""
    return F.btrim(as_col(c), F.lit(_WHITESPACE))


def first_present(*cols) -> Column:
    """P5: first value that is neither NULL nor blank (whitespace-only); the value is returned
    unstripped. A trailing plain literal acts as the default."""
    picks = [F.when(py_strip(as_col(c).cast("string")) != "", as_col(c).cast("string"))
             for c in cols]
    return F.coalesce(*picks)


def truthy_first(*cols) -> Column:
    """Python ``a or b or c`` over strings: NULL and '' are skipped, blanks are kept."""
    picks = [F.when(as_col(c).cast("string") != "", as_col(c).cast("string")) for c in cols]
    return F.coalesce(*picks)


def pipe_segment(name, position: int) -> Column:
    """Stripped 0-based segment of a pipe-delimited name; '' when out of range."""
    parts = F.split(as_col(name), "[|]")
    return F.coalesce(py_strip(F.get(parts, F.lit(position))), F.lit(""))


def inner_segments(name) -> Column:
    """All segments of a pipe-delimited name except the first and last, unstripped.

    ``'| s |'`` occurs in a name exactly when one of these equals ``' s '`` (for ``s`` without a
    pipe), which turns the multi-pattern substring test into an equi-join key.
    """
    parts = F.split(as_col(name), "[|]")
    return F.slice(parts, 2, F.greatest(F.size(parts) - 2, F.lit(0)))


def build_raw_path(raw_root, group_id, obs_ymd, download_ts, prefix: str = "obs") -> Column:
    """``{raw}/{group}/{prefix}__{group}__{YYYYMMDD}__{YYYYMMDDTHHMMSS}.parquet``."""
    root = F.regexp_replace(lit_or_col(raw_root), "/+$", "")
    g = as_col(group_id)
    return F.concat(root, F.lit("/"), g, F.lit(f"/{prefix}__"), g, F.lit("__"),
                    as_col(obs_ymd), F.lit("__"), lit_or_col(download_ts), F.lit(".parquet"))


_RAW_FILE = r"([^/]+)__([^/]+)__([0-9]{8})__([0-9]{8}T[0-9]{6})\.parquet$"


def parse_raw_path(path) -> Column:
    """F7 inverse: STRUCT<prefix, group_id, obs_date, download_ts> from a raw file path."""
    p = as_col(path)
    return F.struct(*[F.regexp_extract(p, _RAW_FILE, i).alias(n)
                      for i, n in enumerate(["prefix", "group_id", "obs_date", "download_ts"], 1)])


def stats_message(row_count, instrument_count, attribute_count) -> Column:
    """``rows=… instruments=… attributes=…``."""
    return F.format_string("rows=%d instruments=%d attributes=%d", as_col(row_count),
                           as_col(instrument_count), as_col(attribute_count))
