"""Thinning a trajectory against the last point that was kept."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetlens import constants as K
from fleetlens.functions import geo
from fleetlens.operators.ordered import with_halo
from fleetlens.session import materialize

POINTS_PER_BLOCK = 1024


def _steps(points: DataFrame, size: int, min_km: float, longest: int) -> DataFrame:
    """trip_id, block, steps: per block the points in order, each with how many points on the next one would be kept."""
    after = Window.partitionBy("trip_id", "__block").orderBy("point_index").rowsBetween(1, longest - 1)
    near = with_halo(points.select("trip_id", "point_index", "lat", "lon"), F.col("point_index"), size, after=longest) \
        .withColumn("__next", F.collect_list(F.struct("point_index", "lat", "lon")).over(after)).filter("__own")
    far = F.filter("__next", lambda p: geo.haversine_km(F.col("lat"), F.col("lon"), p["lat"], p["lon"]) >= min_km)
    step = F.coalesce(F.get(far, F.lit(0))["point_index"] - F.col("point_index"), F.lit(longest))
    return near.groupBy("trip_id", F.col("__block").alias("block")).agg(F.sort_array(F.collect_list(F.struct(
        F.col("point_index").cast("long").alias("at"), step.cast("long").alias("step")))).alias("steps"))


def _exit(steps: Column, entry: Column) -> Column:
    """Where the walk over a block that enters at ``entry`` leaves it."""
    return F.aggregate(steps, entry, lambda to, p: F.when(p["at"] == to, to + p["step"]).otherwise(to))


def _kept(steps: Column, entry: Column) -> Column:
    """The points of a block on the walk that enters at ``entry``."""
    start = F.struct(entry.alias("to"), F.array().cast("array<long>").alias("kept"))
    return F.aggregate(steps, start, lambda w, p: F.when(p["at"] == w["to"], F.struct(
        (p["at"] + p["step"]).alias("to"), F.concat(w["kept"], F.array(p["at"])).alias("kept"))).otherwise(w))["kept"]


def _entries(blocks: DataFrame, size: int, longest: int) -> DataFrame:
    """trip_id, block, entry for the blocks that trips enter after their first one.

    A block maps each place at which it can be entered to the place at which the next one is. These maps are
    composed in pairs, so that a trip of n blocks is done in log2(n) rounds, none of which walks along a trip.
    """
    first = F.col("block") * size
    maps = blocks.select("trip_id", "block", "steps", F.explode(F.sequence(first, first + (longest - 1))).alias("entry")) \
        .select("trip_id", "block", "entry", _exit(F.col("steps"), F.col("entry")).alias("exit"))
    maps = materialize(maps.filter(F.col("exit") >= (F.col("block") + 1) * size), "thinning-maps")
    reached = materialize(blocks.filter("block = 0").select("trip_id", "block", F.lit(0).cast("long").alias("entry")), "thinning-entries")
    most, span = blocks.agg(F.max("block")).first()[0], 1
    while span <= most:
        on = reached.join(maps, ["trip_id", "block", "entry"]).select(
            "trip_id", (F.col("block") + span).alias("block"), F.col("exit").alias("entry"))
        reached = materialize(reached.unionByName(on), "thinning-entries")
        then = maps.select("trip_id", (F.col("block") - span).alias("block"), F.col("entry").alias("exit"), F.col("exit").alias("to"))
        maps = materialize(maps.join(then, ["trip_id", "block", "exit"]).select(
            "trip_id", "block", "entry", F.col("to").alias("exit")), "thinning-maps")
        span *= 2
    return reached.filter("block > 0")


def thin(points: DataFrame, min_km: float = 0.05, min_seconds: int = 60,
         seconds: int = K.GPS_INTERVAL_SECONDS) -> DataFrame:
    """The first point of each trip, and every point that is ``min_km`` or ``min_seconds`` from the one kept before it.

    ``points``: trip_id, point_index, lat, lon and others; the index counts from 0 without gaps, and points are
    ``seconds`` apart. Since each kept point depends on the one before, a trip is a chain; it is cut into blocks
    that are walked at once, for every place where a block can be entered (see ``_entries``).
    """
    longest = max(1, -(-min_seconds // seconds))
    size = max(POINTS_PER_BLOCK, longest)
    blocks = materialize(_steps(points, size, min_km, longest), "thinning-blocks")
    at = F.explode(_kept(F.col("steps"), F.col("entry"))).alias("point_index")
    kept = blocks.filter("block = 0").withColumn("entry", F.lit(0).cast("long")).select("trip_id", at)
    if not blocks.filter("block > 0").isEmpty():
        long = blocks.join(blocks.filter("block > 0").select("trip_id").distinct(), "trip_id", "left_semi")
        later = blocks.join(_entries(long, size, longest), ["trip_id", "block"])
        kept = kept.unionByName(later.select("trip_id", at))
    return points.join(kept, ["trip_id", "point_index"], "left_semi")
