"""Predicate Column builders for the filter grammar of search requests.

Callers write ordinary Spark predicates (``==``, ``!=``, ``<``, ``&``, ``|``,
``~``, ``isin``, ``between``, ``like``); these helpers cover the remaining
forms: JSON paths, epoch-second ranges and empty filters.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def json_path(col, path: str, type_: str = "string") -> Column:
    """Typed value at a JSON path (``$.a.b``) of a JSON string column; null when absent."""
    return F.try_variant_get(F.try_parse_json(_c(col)), path, type_)


def epoch_seconds(ts) -> Column:
    return F.unix_seconds(_c(ts).cast("timestamp"))


def half_open(col, lo, hi) -> Column:
    c = _c(col)
    return (c >= lo) & (c < hi)
