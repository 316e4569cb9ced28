"""Trajectories: speeds, estimates, remapping, thinning, segments, smoothing."""

from __future__ import annotations

from pyspark.sql import functions as F

from fleetlens import constants as K
from fleetlens.functions import timing, trips as tf
from fleetlens.operators import motion, stays, thinning, trajectory as t
from fleetlens.operators.curate import valid_trajectories
from fleetlens.plans import bindings as b
from fleetlens.plans.registry import plain_times, query, r6
from fleetlens.session import scratch_path
from fleetlens.sources import files


def trips(spark, sf_dir):
    return b.trajectories(spark, sf_dir)


def points(spark, sf_dir):
    return b.points(spark, sf_dir)


def _placed(spark, sf_dir):
    """Points with the zone that holds them, null outside all zones."""
    placed = b.zone_lookup(spark, sf_dir).assign(points(spark, sf_dir), nearest_fallback=False)
    return placed.withColumn("zone_id", F.col("zone.zone_id")).drop("zone")


@query(f"WITH {b.POINTS_SQL} SELECT trip_id, CAST(point_index AS INTEGER) AS point_index, "
       "round(lat, 6) AS lat, round(lon, 6) AS lon FROM points")
def explode_points(spark, sf_dir):
    rows = t.explode_points(trips(spark, sf_dir).select("trip_id", "polyline"))
    return rows.select("trip_id", "point_index", r6("lat"), r6("lon"))


@query("SELECT count(*) AS trips, CAST(sum(o_custkey % 13) AS BIGINT) AS points FROM orders WHERE o_custkey % 13 >= 2")
def valid_trips(spark, sf_dir):
    """Through Parquet: written, read with the column check, trips below two points dropped."""
    path = scratch_path(spark, "trajectories")
    rows = trips(spark, sf_dir).withColumn("DAY_TYPE", F.lit("A"))
    files.write_parquet(rows, path)
    return files.read_trajectories(spark, path).agg(
        F.count(F.lit(1)).alias("trips"), F.sum(F.size("polyline")).alias("points"))


_ENDS_SQL = b.POINTS_SQL + f""",
ends AS (
  SELECT trip_id, max(n) AS n, arg_min(lat, point_index) AS lat1, arg_min(lon, point_index) AS lon1,
         arg_max(lat, point_index) AS lat2, arg_max(lon, point_index) AS lon2
  FROM points WHERE n >= 2 GROUP BY 1),
far AS (SELECT *, {b.haversine_sql("lat1", "lon1", "lat2", "lon2")} AS km FROM ends)"""


@query(f"""WITH {_ENDS_SQL}
SELECT trip_id, CAST(n AS INTEGER) AS num_gps_points, round(lat1, 6) AS origin_lat, round(lon1, 6) AS origin_lon,
       round(lat2, 6) AS destination_lat, round(lon2, 6) AS destination_lon FROM far""")
def origin_destination(spark, sf_dir):
    od = t.origin_destination(valid_trajectories(trips(spark, sf_dir)))
    return od.select(
        "trip_id", "num_gps_points", r6(F.col("origin.lat")).alias("origin_lat"),
        r6(F.col("origin.lon")).alias("origin_lon"), r6(F.col("destination.lat")).alias("destination_lat"),
        r6(F.col("destination.lon")).alias("destination_lon"))


_ESTIMATED_SQL = _ENDS_SQL + """,
estimated AS (
  SELECT *, CASE WHEN km > 0 THEN greatest(2::DOUBLE, km / 25 * 60) ELSE 5::DOUBLE END AS minutes,
         2.5::DOUBLE + km * 3.2::DOUBLE AS fare FROM far)"""


@query(f"""WITH {_ESTIMATED_SQL}
SELECT trip_id, round(km, 6) AS estimated_distance_km, round(minutes, 6) AS estimated_duration_min,
       round(fare, 6) AS base_fare FROM estimated WHERE minutes <= 60""")
def trip_estimates(spark, sf_dir):
    rows = t.drop_long_trips(t.estimates(valid_trajectories(trips(spark, sf_dir))))
    return rows.select(
        "trip_id", r6("estimated_distance_km"), r6("estimated_duration_min"), r6("base_fare"))


@query(f"""WITH {_ESTIMATED_SQL},
jitter AS (
  SELECT *, CAST(0.9 AS DOUBLE) + CAST(CAST('0x' || substr(md5(CAST(trip_id AS VARCHAR)), 1, 8) AS BIGINT) % 1001 AS DOUBLE)
            / 1000 * (CAST(1.1 AS DOUBLE) - CAST(0.9 AS DOUBLE)) AS factor FROM estimated)
SELECT trip_id, abs(fare * factor - quoted) < 0.0051 AS close, quoted BETWEEN fare * 0.899 - 0.01 AND fare * 1.101 + 0.01 AS in_range
FROM (SELECT *, round(fare * factor, 2) AS quoted FROM jitter)""")
def quoted_fares(spark, sf_dir):
    rows = t.estimates(valid_trajectories(trips(spark, sf_dir))).withColumn(
        "quoted", tf.quoted_fare(F.col("estimated_distance_km"), F.col("trip_id")))
    low, high = K.FARE_JITTER
    return rows.select(
        "trip_id", (F.col("quoted") >= F.col("base_fare") * low - 0.01).alias("close"),
        (F.col("quoted") <= F.col("base_fare") * high + 0.01).alias("in_range"))


_STEPS_SQL = b.POINTS_SQL + f""",
steps AS (
  SELECT *, lag(lat) OVER w AS plat, lag(lon) OVER w AS plon FROM points
  WINDOW w AS (PARTITION BY trip_id ORDER BY point_index)),
moves AS (SELECT *, {b.haversine_sql("plat", "plon", "lat", "lon")} AS km FROM steps)"""


@query(f"""WITH {_STEPS_SQL},
rated AS (SELECT *, coalesce(round(km / 15 * 3600, 1), 0) AS speed FROM moves)
SELECT trip_id, CAST(point_index AS INTEGER) AS point_index, speed,
       CASE WHEN speed > 2 THEN 'moving' ELSE 'idle' END AS status FROM rated""")
def point_speeds(spark, sf_dir):
    return t.point_speeds(points(spark, sf_dir)).select("trip_id", "point_index", "speed", "status")


@query(f"""WITH {_STEPS_SQL}
SELECT trip_id, CAST(point_index AS INTEGER) AS point_index, coalesce(round(km / 15 * 3600, 1), 0) AS speed FROM moves""")
def trip_speeds(spark, sf_dir):
    """The same speeds from the arrays, without a shuffle."""
    return t.trip_speeds(trips(spark, sf_dir).select("trip_id", "polyline")).select("trip_id", "point_index", "speed")


@query(f"""WITH {_STEPS_SQL}
SELECT trip_id, CAST(point_index AS INTEGER) AS point_index FROM moves
WHERE plat IS NULL OR km >= 2 OR point_index % 4 = 0""")
def adaptive_sample(spark, sf_dir):
    return t.adaptive_sample(points(spark, sf_dir), min_km=2.0).select("trip_id", "point_index")


@query(f"""WITH RECURSIVE {b.POINTS_SQL},
next AS (
  SELECT i.trip_id, i.point_index, min(j.point_index) AS then FROM points i JOIN points j
  ON j.trip_id = i.trip_id AND j.point_index > i.point_index
     AND (j.point_index - i.point_index >= 4 OR {b.haversine_sql("i.lat", "i.lon", "j.lat", "j.lon")} >= 2) GROUP BY ALL),
kept AS (
  SELECT trip_id, point_index FROM points WHERE point_index = 0
  UNION ALL SELECT n.trip_id, n.then FROM kept k JOIN next n ON n.trip_id = k.trip_id AND n.point_index = k.point_index)
SELECT trip_id, CAST(point_index AS INTEGER) AS point_index FROM kept""")
def thin_route(spark, sf_dir):
    """Sampling against the last point kept."""
    return thinning.thin(points(spark, sf_dir), min_km=2.0).select("trip_id", "point_index")


@query(f"""WITH {_STEPS_SQL}
SELECT trip_id, CAST(point_index AS INTEGER) AS point_index,
       sum(CASE WHEN km > 5 THEN 1 ELSE 0 END) OVER (PARTITION BY trip_id ORDER BY point_index)::BIGINT AS segment
FROM moves""")
def segments(spark, sf_dir):
    return t.segments(points(spark, sf_dir)).select("trip_id", "point_index", "segment")


@query(f"""WITH {b.POINTS_SQL}
SELECT trip_id, CAST(point_index AS INTEGER) AS point_index, round(avg(lat) OVER w, 6) AS smooth_lat,
       round(avg(lon) OVER w, 6) AS smooth_lon FROM points
WINDOW w AS (PARTITION BY trip_id ORDER BY point_index ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING)""")
def smooth_route(spark, sf_dir):
    return t.smooth(points(spark, sf_dir), k=2).select(
        "trip_id", "point_index", r6("smooth_lat"), r6("smooth_lon"))


_NOISE, _DENSITY, _SPEED, _STEP = 100.0, 0.5, 15.0, float(K.GPS_INTERVAL_SECONDS)

# Filter forwards in covariance form, then correct backwards. The covariances (a, b, d) depend on the place in the trip
# only; p* are those before the measurement, g* the gains of the correction.
_MOTION_SQL = f"""{b.POINTS_SQL},
spread AS (
  SELECT 0 AS k, 0::DOUBLE AS pa, 0::DOUBLE AS pb, 0::DOUBLE AS pd, {_NOISE ** 2}::DOUBLE AS a, 0::DOUBLE AS b,
         {_SPEED ** 2}::DOUBLE AS d, 1::DOUBLE AS k1, 0::DOUBLE AS k2
  UNION ALL
  SELECT k + 1, pa, pb, pd, pa - k1 * pa, pb - k1 * pb, pd - k2 * pb, k1, k2 FROM (
    SELECT *, pa / (pa + {_NOISE ** 2}::DOUBLE) AS k1, pb / (pa + {_NOISE ** 2}::DOUBLE) AS k2 FROM (
      SELECT k, a + 2 * {_STEP}::DOUBLE * b + {_STEP ** 2}::DOUBLE * d + {_DENSITY * _STEP ** 3 / 3!r}::DOUBLE AS pa,
             b + {_STEP}::DOUBLE * d + {_DENSITY * _STEP ** 2 / 2!r}::DOUBLE AS pb, d + {_DENSITY * _STEP!r}::DOUBLE AS pd
      FROM spread WHERE k < (SELECT max(point_index) FROM points)))),
gains AS (
  SELECT s.k, (u * n.pd - v * n.pb) / det AS g1, (v * n.pa - u * n.pb) / det AS g2,
         (w * n.pd - s.d * n.pb) / det AS g3, (s.d * n.pa - w * n.pb) / det AS g4
  FROM (SELECT *, a + {_STEP}::DOUBLE * b AS u, b AS v, b + {_STEP}::DOUBLE * d AS w FROM spread) s
  JOIN (SELECT *, pa * pd - pb * pb AS det FROM spread) n ON n.k = s.k + 1),
forwards AS (
  SELECT trip_id, 0 AS k, lat AS y, 0::DOUBLE AS vy, lon AS x, 0::DOUBLE AS vx FROM points WHERE point_index = 0
  UNION ALL
  SELECT f.trip_id, f.k + 1, f.y + {_STEP}::DOUBLE * f.vy + s.k1 * (p.lat - f.y - {_STEP}::DOUBLE * f.vy),
         f.vy + s.k2 * (p.lat - f.y - {_STEP}::DOUBLE * f.vy),
         f.x + {_STEP}::DOUBLE * f.vx + s.k1 * (p.lon - f.x - {_STEP}::DOUBLE * f.vx),
         f.vx + s.k2 * (p.lon - f.x - {_STEP}::DOUBLE * f.vx)
  FROM forwards f JOIN points p ON p.trip_id = f.trip_id AND p.point_index = f.k + 1 JOIN spread s ON s.k = f.k + 1),
backwards AS (
  SELECT f.* FROM forwards f JOIN (SELECT trip_id, max(point_index) AS k FROM points GROUP BY 1) l USING (trip_id, k)
  UNION ALL
  SELECT f.trip_id, f.k, f.y + g1 * (n.y - f.y - {_STEP}::DOUBLE * f.vy) + g2 * (n.vy - f.vy),
         f.vy + g3 * (n.y - f.y - {_STEP}::DOUBLE * f.vy) + g4 * (n.vy - f.vy),
         f.x + g1 * (n.x - f.x - {_STEP}::DOUBLE * f.vx) + g2 * (n.vx - f.vx),
         f.vx + g3 * (n.x - f.x - {_STEP}::DOUBLE * f.vx) + g4 * (n.vx - f.vx)
  FROM backwards n JOIN forwards f ON f.trip_id = n.trip_id AND f.k = n.k - 1 JOIN gains g ON g.k = f.k)"""


@query(f"""WITH RECURSIVE {_MOTION_SQL}
SELECT trip_id, CAST(k AS INTEGER) AS point_index, round(y, 5) AS motion_lat, round(x, 5) AS motion_lon FROM backwards""")
def motion_route(spark, sf_dir):
    """Smoothing by a motion model, to 5 decimals, since both sides run in another order."""
    rows = motion.smooth(points(spark, sf_dir), _NOISE, _DENSITY, _SPEED)
    return rows.select("trip_id", "point_index", *[F.round(c, 5).alias(c) for c in ("motion_lat", "motion_lon")])


@query(f"""WITH RECURSIVE {b.POINTS_SQL},
ends AS (
  SELECT i.trip_id, i.point_index, any_value(i.n) AS n, any_value(i.lat) AS lat, any_value(i.lon) AS lon,
         coalesce(min(j.point_index), any_value(i.n)) AS "end" FROM points i LEFT JOIN points j
  ON j.trip_id = i.trip_id AND j.point_index > i.point_index AND {b.haversine_sql("i.lat", "i.lon", "j.lat", "j.lon")} > 3
  GROUP BY 1, 2),
steps AS (SELECT *, ("end" - 1 - point_index) * 15 >= 30 AS stay FROM ends),
walk AS (
  SELECT * FROM steps WHERE point_index = 0
  UNION ALL
  SELECT s.* FROM walk w JOIN steps s
  ON s.trip_id = w.trip_id AND s.point_index = CASE WHEN w.stay THEN w."end" ELSE w.point_index + 1 END)
SELECT trip_id, CAST(point_index AS BIGINT) AS first_index, CAST("end" - 1 AS BIGINT) AS last_index,
       CAST(("end" - 1 - point_index) * 15 AS BIGINT) AS seconds, round(lat, 6) AS lat, round(lon, 6) AS lon
FROM walk WHERE stay""")
def stay_points(spark, sf_dir):
    """Stretches of at least 30 s within 3 km; the points of the trips at hand are few and far apart."""
    rows = stays.stays(points(spark, sf_dir), radius_km=3.0, min_seconds=30)
    return rows.select("trip_id", "first_index", "last_index", "seconds", r6("lat"), r6("lon"))


# --- remapping between boxes ---------------------------------------------------------------------
_SOURCE_BOX = (33.45, 33.65, -7.75, -7.49)
_TARGET_BOX = (K.LAT_MIN, K.LAT_MAX, K.LON_MIN, K.LON_MAX)


def _scaled_sql(c: str, lo: float, hi: float, new_lo: float, new_hi: float) -> str:
    d = lambda v: f"CAST({v} AS DOUBLE)"
    return f"({d(new_lo)} + ({c} - {d(lo)}) / {d(hi - lo)} * {d(new_hi - new_lo)})"


@query(f"""WITH {b.POINTS_SQL}
SELECT trip_id, CAST(point_index AS INTEGER) AS point_index,
       round({_scaled_sql("lat", 33.45, 33.65, K.LAT_MIN, K.LAT_MAX)}, 6) AS lat,
       round({_scaled_sql("lon", -7.75, -7.49, K.LON_MIN, K.LON_MAX)}, 6) AS lon FROM points""")
def remap_box(spark, sf_dir):
    moved = trips(spark, sf_dir).select(
        "trip_id", t.remap_box(F.col("polyline"), _SOURCE_BOX, _TARGET_BOX).alias("polyline"))
    return t.explode_points(moved).select("trip_id", "point_index", r6("lat"), r6("lon"))


@query(f"""WITH {b.POINTS_SQL}
SELECT trip_id, CAST(point_index AS INTEGER) AS point_index,
       round(greatest(33.47::DOUBLE, least(33.63::DOUBLE, lat)), 6) AS lat,
       round(greatest(-7.73::DOUBLE, least(-7.51::DOUBLE, lon)), 6) AS lon FROM points""")
def clamp_points(spark, sf_dir):
    moved = trips(spark, sf_dir).select("trip_id", t.clamp_to_box(F.col("polyline")).alias("polyline"))
    return t.explode_points(moved).select("trip_id", "point_index", r6("lat"), r6("lon"))


@query(f"""WITH {b.POINTS_SQL}, counted AS (
  SELECT trip_id, count(*) AS points, count(*) FILTER ({b.IN_BOX_SQL}) AS points_kept FROM points GROUP BY 1)
SELECT trip_id, points, points_kept, points_kept = points AS valid FROM counted""")
def drop_outliers(spark, sf_dir):
    kept = F.size(t.drop_outliers(F.col("polyline"))).cast("bigint")
    rows = trips(spark, sf_dir).filter(F.size("polyline") > 0).select(
        "trip_id", F.size("polyline").cast("bigint").alias("points"), kept.alias("points_kept"))
    return rows.withColumn("valid", F.col("points_kept") == F.col("points"))


_PLACED_SQL = b.POINTS_SQL + "," + b.ZONES_SQL + """,
numbered AS (SELECT trip_id * 16 + point_index AS id, * FROM points),""" + b.containment_sql("numbered") + """,
placed AS (
  SELECT n.trip_id, n.point_index, z.zone_id FROM numbered n
  LEFT JOIN containing c ON c.id = n.id LEFT JOIN zones z ON z.seq = c.seq)"""

_SHARE_SQL = _PLACED_SQL + """,
shares AS (SELECT trip_id, count(*) AS points, count(zone_id) AS points_inside FROM placed GROUP BY 1)"""


@query(f"""WITH {_SHARE_SQL}
SELECT trip_id, points, points_inside, round(points_inside / points, 6) AS inside_ratio,
       points_inside = points AS all_inside FROM shares""")
def inside_share(spark, sf_dir):
    return t.inside_share(_placed(spark, sf_dir)).select(
        "trip_id", "points", "points_inside", r6("inside_ratio"), "all_inside")


@query(f"WITH {_SHARE_SQL} SELECT trip_id, points, points_inside FROM shares WHERE points_inside / points >= 0.8")
def mostly_inside(spark, sf_dir):
    return t.mostly_inside(_placed(spark, sf_dir), 0.8).select("trip_id", "points", "points_inside")


@query(f"WITH {_PLACED_SQL} SELECT zone_id, count(*) AS points, count(DISTINCT trip_id) AS trips "
       "FROM placed WHERE zone_id IS NOT NULL GROUP BY 1")
def district_trajectories(spark, sf_dir):
    """Points and trips per district; points are counted per trip first."""
    inside = _placed(spark, sf_dir).filter(F.col("zone_id").isNotNull())
    per_trip = inside.groupBy("zone_id", "trip_id").agg(F.count(F.lit(1)).alias("points"))
    return per_trip.groupBy("zone_id").agg(
        F.sum("points").alias("points"), F.count(F.lit(1)).alias("trips"))


@query(f"""WITH {_ESTIMATED_SQL}
SELECT trip_id, CAST(trip_id % 16 + 1 AS INTEGER) AS origin_zone,
       o_orderdate AS requested_at, round(lat1, 6) AS origin_lat, round(lon2, 6) AS destination_lon,
       abs(km - round(km, 3)) < 0.001 AS distance_ok, CAST(n AS INTEGER) AS num_gps_points,
       CASE WHEN dayofweek(o_orderdate) = 5 THEN 0.2::DOUBLE ELSE 0.2::DOUBLE END AS demand_multiplier
FROM estimated JOIN orders ON o_orderkey = trip_id WHERE minutes <= 60""")
def trip_requests(spark, sf_dir):
    """Requests as published: nested end points, through JSON and back."""
    from fleetlens import schemas
    rows = t.drop_long_trips(t.estimates(t.origin_destination(valid_trajectories(trips(spark, sf_dir)))))
    at = F.timestamp_seconds("timestamp")

    def rounded(c):
        return F.struct(F.round(F.col(f"{c}.lat"), 7).alias("lat"), F.round(F.col(f"{c}.lon"), 7).alias("lon"))

    message = F.to_json(F.struct(
        F.col("trip_id").cast("string").alias("trip_id"), "origin_zone", "destination_zone",
        at.alias("requested_at"), at.alias("timestamp_utc"), rounded("origin").alias("origin"),
        rounded("destination").alias("destination"),
        F.round("estimated_distance_km", 3).alias("estimated_distance_km"),
        F.round("estimated_duration_min", 1).alias("estimated_duration_min"), "num_gps_points",
        F.lit("requested").alias("status"), timing.demand_multiplier(at).alias("demand_multiplier")))
    sent = rows.select(message.alias("value"), "estimated_distance_km")
    read = sent.select(
        F.col("estimated_distance_km").alias("km"), F.inline(F.array(F.from_json("value", schemas.TRIP_REQUEST))))
    return plain_times(read.select(
        F.col("trip_id").cast("bigint").alias("trip_id"), "origin_zone", "requested_at",
        r6(F.col("origin.lat")).alias("origin_lat"), r6(F.col("destination.lon")).alias("destination_lon"),
        (F.abs(F.col("km") - F.col("estimated_distance_km")) < 0.001).alias("distance_ok"),
        "num_gps_points", "demand_multiplier"), "requested_at")
