from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_col(c) -> Column:
    """Accept a column name or a Column."""
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, body) -> Column:
    """Bind ``value`` once and evaluate ``body(v)`` on it.

    Keeps expression trees linear when a derived value is used several times
    (each use refers to the lambda variable instead of a copy of the
    expression tree).
    """
    return F.get(F.transform(F.array(value), body), 0)
