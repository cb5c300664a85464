"""Status projections and error classification."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import as_col

# Ordered error-type rules (first match wins).
ERROR_RULES = [
    ("dns_failure", ["failed to resolve", "name resolution"]),
    ("http_403", ["403", "forbidden"]),
    ("timeout", ["timeout"]),
    ("parse_failure", ["parse"]),
    ("http_failure", ["http", "httpsconnectionpool", "max retries exceeded"]),
]
UNKNOWN_ERROR = "unknown_error"

PUBLISHABLE_STATUSES = ["completed", "partial"]


def error_type(c) -> Column:
    """Error type of a message; NULL/blank -> NULL."""
    msg = as_col(c)
    low = F.lower(msg)
    out = None
    for name, needles in ERROR_RULES:
        cond = F.lit(False)
        for n in needles:
            cond = cond | low.contains(n)
        out = F.when(cond, F.lit(name)) if out is None else out.when(cond, F.lit(name))
    return F.when(F.coalesce(msg, F.lit("")) == "", F.lit(None).cast("string")).otherwise(
        out.otherwise(F.lit(UNKNOWN_ERROR)))


def fetch_status(body) -> Column:
    """``fetched`` when the body is non-empty, else ``partial``."""
    return F.when(F.coalesce(as_col(body), F.lit("")) != "", F.lit("fetched")).otherwise(F.lit("partial"))


def processing_status(fetch) -> Column:
    """``fetched`` -> ``completed``; other values unchanged."""
    f = as_col(fetch)
    return F.when(f == "fetched", F.lit("completed")).otherwise(f)


def with_freshness(df: DataFrame, freshness: str | Column = "current") -> DataFrame:
    """Add or overwrite ``data_freshness`` on every row."""
    value = freshness if isinstance(freshness, Column) else F.lit(freshness)
    return df.withColumn("data_freshness", value)
