"""Named queries over the supplied tables, with their SQL twins where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function name. ``sql`` is left out where SQL cannot express it."""
    def add(fn: Query) -> Query:
        key = name or fn.__name__
        QUERIES[key] = fn
        if sql is not None:
            ORACLE[key] = sql
        return fn
    return add


def r6(column: str | Column) -> Column:
    """Doubles are compared to 6 decimals, since sums may run in any order."""
    named = F.col(column) if isinstance(column, str) else column
    rounded = F.round(named, 6)
    return rounded.alias(column) if isinstance(column, str) else rounded


def plain_times(df: DataFrame, *columns: str) -> DataFrame:
    """Timestamps as plain UTC times, as the tables hold them."""
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})
