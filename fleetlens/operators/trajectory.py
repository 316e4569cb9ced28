"""Trajectories as arrays of [lon, lat] points: everything happens inside a row, without a shuffle.

``*_points`` functions work on one row per point; they cut long trips into blocks (see ``ordered``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetlens import constants as K
from fleetlens.functions import geo, trips as tf
from fleetlens.operators.ordered import Running, drop_halo, running, with_halo

POINTS_PER_BLOCK = 4096


def explode_points(trips: DataFrame, column: str = "polyline") -> DataFrame:
    """One row per point with its index, starting at 0."""
    others = [c for c in trips.columns if c != column]
    return trips.select(*others, F.posexplode(column).alias("point_index", "p")).select(
        *others, "point_index", F.col("p")[1].alias("lat"), F.col("p")[0].alias("lon"))


def origin_destination(trips: DataFrame, column: str = "polyline") -> DataFrame:
    """Add origin, destination (structs) and the number of points."""
    points = F.col(column)
    return trips.withColumns({
        "origin": tf.endpoint(points, last=False),
        "destination": tf.endpoint(points, last=True),
        "num_gps_points": F.size(points),
    })


def estimates(trips: DataFrame, column: str = "polyline") -> DataFrame:
    """Add distance, duration and base fare from the end points."""
    return trips.withColumn("estimated_distance_km", tf.end_to_end_km(F.col(column))).withColumns({
        "estimated_duration_min": tf.estimated_minutes(F.col("estimated_distance_km")),
        "base_fare": tf.base_fare(F.col("estimated_distance_km")),
    })


def drop_long_trips(trips: DataFrame, limit: float = K.MAX_TRIP_MINUTES) -> DataFrame:
    return trips.filter(F.col("estimated_duration_min") <= limit)


def trip_speeds(trips: DataFrame, column: str = "polyline", seconds: float = K.GPS_INTERVAL_SECONDS) -> DataFrame:
    """One row per point with the speed since the point before, 0.0 at the first; no shuffle.

    Every point is paired with its predecessor inside the array (the first one with itself) and the pairs
    are exploded, so the distance is computed in generated code, not in a lambda.
    """
    points = F.col(column)
    before = F.concat(F.slice(points, 1, 1), F.slice(points, F.lit(1), F.greatest(F.size(points) - 1, F.lit(0))))
    others = [c for c in trips.columns if c != column]
    pairs = trips.select(*others, F.posexplode(F.arrays_zip(
        points.alias("p"), before.alias("q"))).alias("point_index", "pair"))
    rows = pairs.select(
        *others, "point_index", F.col("pair.p")[1].alias("lat"), F.col("pair.p")[0].alias("lon"),
        F.col("pair.q")[1].alias("__lat"), F.col("pair.q")[0].alias("__lon"))
    distance = geo.haversine_km(F.col("__lat"), F.col("__lon"), F.col("lat"), F.col("lon"))
    return _with_status(rows.withColumn("speed", geo.speed_kmh(distance, F.lit(seconds)))).drop("__lat", "__lon")


def _with_status(points: DataFrame) -> DataFrame:
    return points.withColumn("status", F.when(F.col("speed") > K.MOVING_ABOVE_KMH, "moving").otherwise("idle"))


def _near_index(points: DataFrame, before: int, after: int) -> DataFrame:
    return with_halo(points, F.col("point_index"), max(POINTS_PER_BLOCK, before, after), before, after)


def _block_order() -> Window:
    return Window.partitionBy("trip_id", "__block").orderBy("point_index")


def point_speeds(points: DataFrame, seconds: float = K.GPS_INTERVAL_SECONDS) -> DataFrame:
    """Speed and moving/idle status per point row, from the previous point of the trip."""
    w = _block_order()
    near = _near_index(points, 1, 0).withColumns({
        "prev_lat": F.lag("lat").over(w), "prev_lon": F.lag("lon").over(w)})
    rows = drop_halo(near)
    distance = geo.haversine_km(F.col("prev_lat"), F.col("prev_lon"), F.col("lat"), F.col("lon"))
    speed = F.coalesce(geo.speed_kmh(distance, F.lit(seconds)), F.lit(0.0))
    return _with_status(rows.withColumn("speed", speed)).drop("prev_lat", "prev_lon")


def adaptive_sample(points: DataFrame, min_km: float = 0.05, min_seconds: int = 60,
                    seconds: int = K.GPS_INTERVAL_SECONDS) -> DataFrame:
    """Thin a trajectory: keep a point if it moved far enough, or its turn in time has come.

    The first point, points at least ``min_km`` from the point before, and every point whose index
    fills ``min_seconds`` are kept.
    """
    w = _block_order()
    near = _near_index(points, 1, 0).withColumns({
        "prev_lat": F.lag("lat").over(w), "prev_lon": F.lag("lon").over(w)})
    rows = drop_halo(near)
    distance = geo.haversine_km(F.col("prev_lat"), F.col("prev_lon"), F.col("lat"), F.col("lon"))
    every = max(1, min_seconds // seconds)
    keep = F.col("prev_lat").isNull() | (distance >= min_km) | (F.col("point_index") % every == 0)
    return rows.filter(keep).drop("prev_lat", "prev_lon")


def segments(points: DataFrame, max_step_km: float = 5.0) -> DataFrame:
    """Number the pieces of a trip; a new piece starts where a step is longer than the limit."""
    w = _block_order()
    near = _near_index(points, 1, 0).withColumns({
        "prev_lat": F.lag("lat").over(w), "prev_lon": F.lag("lon").over(w)})
    rows = drop_halo(near)
    distance = geo.haversine_km(F.col("prev_lat"), F.col("prev_lon"), F.col("lat"), F.col("lon"))
    breaks = F.coalesce((distance > max_step_km).cast("int"), F.lit(0))
    return running(
        rows.withColumn("__break", breaks).drop("prev_lat", "prev_lon"),
        ["trip_id"], ["point_index"], F.floor(F.col("point_index") / POINTS_PER_BLOCK),
        {"segment": Running("sum", F.col("__break"))}).drop("__break")


def smooth(points: DataFrame, k: int = 1) -> DataFrame:
    """Centred mean over the k points before and after."""
    w = _block_order().rangeBetween(-k, k)
    near = _near_index(points, k, k).withColumns({
        "smooth_lat": F.avg("lat").over(w), "smooth_lon": F.avg("lon").over(w)})
    return drop_halo(near)


def remap_box(points: Column, source: tuple[float, float, float, float],
              target: tuple[float, float, float, float]) -> Column:
    """Linear map of all points from one box to another; boxes are (lat_lo, lat_hi, lon_lo, lon_hi)."""
    s, t = source, target
    return F.transform(points, lambda p: F.array(
        geo.rescale(p[0], s[2], s[3], t[2], t[3]), geo.rescale(p[1], s[0], s[1], t[0], t[1])))


def clamp_to_box(points: Column) -> Column:
    """Pull every point to the nearest place inside the city box."""
    return F.transform(points, lambda p: F.array(
        F.greatest(F.lit(K.LON_MIN), F.least(F.lit(K.LON_MAX), p[0])),
        F.greatest(F.lit(K.LAT_MIN), F.least(F.lit(K.LAT_MAX), p[1]))))


def drop_outliers(points: Column) -> Column:
    """Remove the points outside the city box."""
    return F.filter(points, lambda p: geo.in_city_box(p[1], p[0]))


def inside_share(points: DataFrame, zone: str = "zone_id") -> DataFrame:
    """Per trip: points, points with a zone, share inside, and whether all are inside."""
    return (
        points.groupBy("trip_id")
        .agg(F.count(F.lit(1)).alias("points"), F.count(zone).alias("points_inside"))
        .withColumn("inside_ratio", F.col("points_inside") / F.col("points"))
        .withColumn("all_inside", F.col("points_inside") == F.col("points")))


def mostly_inside(points: DataFrame, threshold: float = 0.5, zone: str = "zone_id") -> DataFrame:
    return inside_share(points, zone).filter(F.col("inside_ratio") >= threshold)


def density(points: DataFrame, size: float = 0.01) -> DataFrame:
    """Points per square cell."""
    return points.groupBy(
        geo.cell(F.col("lat"), size).alias("lat_cell"), geo.cell(F.col("lon"), size).alias("lon_cell")
    ).agg(F.count(F.lit(1)).alias("points"))
