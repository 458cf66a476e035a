"""Argument normalisation shared by the column helpers.

The feature helpers take column *names* and return one SQL expression
(``F.expr``): a single parse on the driver, where the equivalent chain of
``when``/``lit``/``col`` calls costs one JVM round trip per call. The
resulting plan is the same.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_column(c: Column | str) -> Column:
    """A column name or a Column -> Column."""
    return F.col(c) if isinstance(c, str) else c


def ident(name: str) -> str:
    """A column name quoted for use inside SQL expression text."""
    if not isinstance(name, str):
        raise TypeError(f"expected a column name, got {type(name).__name__}")
    return "`" + name.replace("`", "``") + "`"


def sql_literal(value) -> str:
    """A Python literal as SQL text (doubles stay doubles)."""
    if isinstance(value, str):
        return "'" + value.replace("'", "''") + "'"
    if isinstance(value, float):
        return f"CAST({value!r} AS DOUBLE)"
    return str(value)
