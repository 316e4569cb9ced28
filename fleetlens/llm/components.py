"""Connected components of a graph whose links are a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens.session import materialize


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the least node around it."""
    both = links.unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node itself, is linked to the least of them."""
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    return down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")) \
        .unionAll(least.select("a", F.col("m").alias("b")))


def components(links: DataFrame) -> DataFrame:
    """node, root for every node of ``links`` (columns a, b): root is the least node that it reaches.

    Stars are contracted in turn until nothing changes, which takes a few rounds. Each round is written to the
    shared folder; only a count and a checksum of it reach the driver. Links of a node with itself or with
    null are left out, so a node without others has no row.
    """
    def state(table: DataFrame) -> tuple:
        return tuple(table.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    now = materialize(links.filter("a <> b").select("a", "b").distinct(), "links")
    seen = state(now)
    while seen[0]:
        large = _large_star(now).filter("a <> b").distinct()
        now = materialize(_small_star(large).filter("a <> b").distinct(), "links")
        was, seen = seen, state(now)
        if was == seen:
            break
    roots = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionAll(roots.select(F.col("root").alias("node"), "root").distinct())
