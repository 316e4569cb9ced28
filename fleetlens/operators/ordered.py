"""Ordered computations that do not need a whole key in one task.

A plain window puts all rows of a key into one task. Here a key is cut into blocks of its order
column; each block is windowed on its own. What a block needs from outside comes either from a
one-row-per-block summary (running values) or from copies of the few rows next to its border (halo).
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_COMBINE = {
    "max": (F.max, lambda a, b: F.greatest(a, b)),
    "min": (F.min, lambda a, b: F.least(a, b)),
    "sum": (F.sum, lambda a, b: F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0))),
}


class Running(NamedTuple):
    """A running ``max``, ``min`` or ``sum`` of a value, from the first row on or ``backwards`` from the last."""

    kind: str
    value: Column
    backwards: bool = False
    inclusive: bool = True


def running(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], block: Column, values: dict[str, Running],
) -> DataFrame:
    """Add running columns along ``order`` within ``keys``; all of them share one shuffle of the rows.

    ``block`` must not decrease along ``order``.
    """
    by_block = [*keys, "__block"]
    rows = df.withColumns({"__block": block, **{f"__v_{n}": r.value for n, r in values.items()}})

    def window(partition: list[str], along: Sequence[str], r: Running, end: int) -> Window:
        sort = [F.col(c).desc() if r.backwards else F.col(c).asc() for c in along]
        return Window.partitionBy(*partition).orderBy(*sort).rowsBetween(Window.unboundedPreceding, end)

    sums = rows.groupBy(*by_block).agg(
        *[_COMBINE[r.kind][0](f"__v_{n}").alias(f"__s_{n}") for n, r in values.items()])
    carry = sums.select(*by_block, *[
        _COMBINE[r.kind][0](f"__s_{n}").over(window(list(keys), ["__block"], r, -1)).alias(f"__c_{n}")
        for n, r in values.items()])
    inside = rows.withColumns({
        f"__w_{n}": _COMBINE[r.kind][0](f"__v_{n}").over(window(by_block, order, r, 0 if r.inclusive else -1))
        for n, r in values.items()})
    result = {n: _COMBINE[r.kind][1](F.col(f"__w_{n}"), F.col(f"__c_{n}")) for n, r in values.items()}
    return inside.join(carry, by_block, "left").withColumns(result).select(*df.columns, *values)


def with_halo(df: DataFrame, position: Column, size: int, before: int = 0, after: int = 0) -> DataFrame:
    """Copy rows near a block border into the neighbouring block.

    ``position`` is a whole number (a row index or epoch seconds) and ``size`` the block length in the
    same unit. A block then also holds the rows up to ``before`` units ahead of its start and ``after``
    units past its end. ``__own`` marks the one copy of each row that belongs to its own block.
    ``size`` must be at least ``before`` and ``after``.
    """
    if size < max(before, after):
        raise ValueError("the blocks are shorter than the halo")
    own, low, high = (F.floor(p / size) for p in (position, position - after, position + before))
    blocks = F.when(low == high, F.array(own)).otherwise(F.array_distinct(F.array(low, own, high)))
    return (
        df.withColumn("__home", own)
        .withColumn("__block", F.explode(blocks))
        .withColumn("__own", F.col("__block") == F.col("__home"))
        .drop("__home"))


def drop_halo(df: DataFrame) -> DataFrame:
    return df.filter("__own").drop("__own", "__block")
