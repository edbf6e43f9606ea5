"""Failure classification.

F8 is an ordered list of substring rules over the lower-cased message; the first rule that hits
wins. Matching is plain substring matching, so a path containing ``20240102`` also contains
``401``; :func:`classify_failure_words` is the word-boundary variant.
"""
from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

from tessera.util import as_col

# Rule order, keys and outcomes must equal the source behaviour.
# (category, strategy, wait_s, substrings)
FAILURE_RULES = [
    ("rate_limit", "long_backoff", 180, ["429", "rate limit", "too many requests", "quota"]),
    ("auth_error", "sleep_and_retry", 60, ["401", "403", "unauthor", "invalid_token", "token expired"]),
    ("empty_payload", "skip", 0, ["204", "no content", "empty", "0 rows"]),
    ("timeout", "long_backoff", 90, ["timeouterror", "timed out", "timeout", "connection reset", "ssl"]),
    ("validation_failed", "retry", 15, ["validation"]),
]
FAILURE_FALLBACK = ("unknown", "std_backoff", 30)
# Texts that mark an empty ("no content") response.
NO_CONTENT_MARKERS = ["no content", "'204'", "code': '204'"]


def _outcome(category: str, strategy: str, wait_s: int) -> Column:
    return F.struct(F.lit(category).alias("category"), F.lit(strategy).alias("strategy"),
                    F.lit(wait_s).cast("int").alias("wait_s"))


def _classify(message, hit) -> Column:
    s = F.lower(F.coalesce(as_col(message).cast("string"), F.lit("")))
    out = None
    for category, strategy, wait_s, keys in FAILURE_RULES:
        cond = hit(s, keys[0])
        for k in keys[1:]:
            cond = cond | hit(s, k)
        out = (F.when(cond, _outcome(category, strategy, wait_s)) if out is None
               else out.when(cond, _outcome(category, strategy, wait_s)))
    return out.otherwise(_outcome(*FAILURE_FALLBACK))


def classify_failure(message) -> Column:
    """F8: STRUCT<category, strategy, wait_s>; NULL or '' -> unknown."""
    return _classify(message, lambda s, k: s.contains(k))


def classify_failure_words(message) -> Column:
    """F8 variant that only matches the numeric codes as whole words (answers D7)."""
    def hit(s, k):
        if k.isdigit():
            return s.rlike(r"(^|[^0-9])" + re.escape(k) + r"([^0-9]|$)")
        return s.contains(k)
    return _classify(message, hit)


def is_no_content(message) -> Column:
    """does an error text mean "no content" (an empty, not failed, response)?"""
    s = F.lower(F.coalesce(as_col(message).cast("string"), F.lit("")))
    cond = (s.contains("field required") & s.contains("instruments"))
    for k in NO_CONTENT_MARKERS:
        cond = cond | s.contains(k)
    return cond
