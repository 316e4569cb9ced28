"""Binds the supplied tables to the domain. Each binding has a twin as SQL text for the checks.

The arithmetic on both sides is the same, on whole numbers first, so values agree to the last bit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens import schemas
from fleetlens.functions import geo
from fleetlens.operators.gps import ZoneLookup
from fleetlens.session import use_utc
from fleetlens.sources.zones import zone_dimension


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    use_utc(spark)
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def _utc(c: Column) -> Column:
    """The tables hold times without a zone; they mean UTC."""
    return c.cast("timestamp")


def _padded(value: Column, width: int) -> Column:
    return F.lpad(value.cast("string"), width, "0")


# --- raw trips from orders and lineitem -------------------------------------------------------

def raw_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw trips from ``orders``: text columns, polylines of 0 to 8 points, some of them null."""
    o = table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    key, n = F.col("o_orderkey"), F.col("o_custkey") % 9
    dow = F.dayofweek("o_orderdate")
    point = lambda i: F.concat(
        F.lit("[-7."), _padded(511 + (key * 31 + i * 7) % 219, 3),
        F.lit(",33."), _padded(471 + (key * 17 + i * 5) % 158, 3), F.lit("]"))
    points = F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), point)
    text = F.concat(F.lit("["), F.when(n > 0, F.array_join(points, ",")).otherwise(""), F.lit("]"))
    return o.select(
        key.cast("string").alias("TRIP_ID"),
        F.when(F.col("o_orderstatus") == "F", "A").when(F.col("o_orderstatus") == "O", "B")
        .otherwise("C").alias("CALL_TYPE"),
        F.col("o_custkey").cast("string").alias("TAXI_ID"),
        F.unix_timestamp(_utc(F.col("o_orderdate"))).cast("string").alias("TIMESTAMP"),
        F.when(dow.isin(1, 7), "C").when(dow == 6, "B").otherwise("A").alias("DAY_TYPE"),
        F.when(key % 11 != 0, text).alias("POLYLINE"))


RAW_TRIPS_SQL = """
raw_trips AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS TRIP_ID,
         CASE o_orderstatus WHEN 'F' THEN 'A' WHEN 'O' THEN 'B' ELSE 'C' END AS CALL_TYPE,
         CAST(o_custkey AS VARCHAR) AS TAXI_ID,
         CAST(CAST(epoch(o_orderdate) AS BIGINT) AS VARCHAR) AS "TIMESTAMP",
         CASE WHEN dayofweek(o_orderdate) IN (0, 6) THEN 'C'
              WHEN dayofweek(o_orderdate) = 5 THEN 'B' ELSE 'A' END AS DAY_TYPE,
         CASE WHEN o_orderkey % 11 = 0 THEN NULL WHEN o_custkey % 9 = 0 THEN '[]'
              ELSE '[' || array_to_string(list_transform(range(1, o_custkey % 9 + 1), lambda i:
                '[-7.' || lpad(CAST(511 + (o_orderkey * 31 + i * 7) % 219 AS VARCHAR), 3, '0') ||
                ',33.' || lpad(CAST(471 + (o_orderkey * 17 + i * 5) % 158 AS VARCHAR), 3, '0') || ']'), ',')
              || ']' END AS POLYLINE,
         CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_custkey % 9 END AS n_points,
         o_orderkey
  FROM orders)"""


def repeated_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw trips from ``lineitem``, whose order keys repeat."""
    li = table(spark, sf_dir, "lineitem", "l_orderkey", "l_partkey", "l_suppkey", "l_shipdate")
    return li.select(
        F.col("l_orderkey").cast("string").alias("TRIP_ID"),
        F.unix_timestamp(_utc(F.col("l_shipdate"))).cast("string").alias("TIMESTAMP"),
        F.concat(
            F.lit("[[-7."), _padded(511 + F.col("l_partkey") % 219, 3), F.lit(",33."),
            _padded(471 + F.col("l_suppkey") % 158, 3), F.lit("]]")).alias("POLYLINE"))


REPEATED_TRIPS_SQL = """
repeated_trips AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS TRIP_ID,
         CAST(CAST(epoch(l_shipdate) AS BIGINT) AS VARCHAR) AS "TIMESTAMP",
         '[[-7.' || lpad(CAST(511 + l_partkey % 219 AS VARCHAR), 3, '0') || ',33.' ||
         lpad(CAST(471 + l_suppkey % 158 AS VARCHAR), 3, '0') || ']]' AS POLYLINE
  FROM lineitem)"""


# --- trajectories from orders ------------------------------------------------------------------

def trajectories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips with 0 to 12 points, made from the order key; consecutive points lie up to a few km apart."""
    o = table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    key = F.col("o_orderkey")
    point = lambda i: F.array(
        F.lit(-7.75) + ((key * 31 + i * (key % 13 + 1) * 3) % 2600) / F.lit(10000.0),
        F.lit(33.45) + ((key * 17 + i * (key % 7 + 1) * 5) % 2000) / F.lit(10000.0))
    n = F.col("o_custkey") % 13
    points = F.when(n > 0, F.transform(F.sequence(F.lit(1).cast("bigint"), n), point)).otherwise(
        F.array().cast("array<array<double>>"))
    return o.select(
        key.alias("trip_id"), (key % 16 + 1).cast("int").alias("origin_zone"),
        (F.col("o_custkey") % 16 + 1).cast("int").alias("destination_zone"),
        F.unix_timestamp(_utc(F.col("o_orderdate"))).cast("int").alias("timestamp"),
        F.when(F.col("o_orderstatus") == "F", "A").when(F.col("o_orderstatus") == "O", "B")
        .otherwise("C").alias("CALL_TYPE"),
        F.col("o_custkey").cast("int").alias("TAXI_ID"), points.alias("polyline"))


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The points of the same trips, one row each, as a GPS log holds them."""
    o = table(spark, sf_dir, "orders", "o_orderkey", "o_custkey")
    key, i, n = F.col("trip_id"), F.col("i"), F.col("o_custkey") % 13
    rows = o.filter(n > 0).select(
        F.col("o_orderkey").alias("trip_id"), F.explode(F.sequence(F.lit(1).cast("bigint"), n)).alias("i"))
    return rows.select(
        "trip_id", (i - 1).cast("int").alias("point_index"),
        (F.lit(33.45) + ((key * 17 + i * (key % 7 + 1) * 5) % 2000) / F.lit(10000.0)).alias("lat"),
        (F.lit(-7.75) + ((key * 31 + i * (key % 13 + 1) * 3) % 2600) / F.lit(10000.0)).alias("lon"))


POINTS_SQL = """
points AS (
  SELECT trip_id, i - 1 AS point_index, n,
         CAST(-7.75 AS DOUBLE) + CAST((trip_id * 31 + i * (trip_id % 13 + 1) * 3) % 2600 AS DOUBLE) / 10000 AS lon,
         CAST(33.45 AS DOUBLE) + CAST((trip_id * 17 + i * (trip_id % 7 + 1) * 5) % 2000 AS DOUBLE) / 10000 AS lat
  FROM (SELECT o_orderkey AS trip_id, o_custkey % 13 AS n, unnest(range(1, o_custkey % 13 + 1)) AS i
        FROM orders))"""


def haversine_sql(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    half_lat = f"sin(radians({lat2} - {lat1}) / 2)"
    half_lon = f"sin(radians({lon2} - {lon1}) / 2)"
    chord = (f"{half_lat} * {half_lat} + cos(radians({lat1})) * cos(radians({lat2})) * {half_lon} * {half_lon}")
    return f"(CAST(12742.0 AS DOUBLE) * asin(sqrt(least(greatest({chord}, 0::DOUBLE), 1::DOUBLE))))"


# --- GPS events and requests from events ---------------------------------------------------------

def _lat() -> Column:
    return F.lit(33.46) + ((F.col("event_id") * 37) % 1800) / F.lit(10000.0)


def _lon() -> Column:
    return F.lit(-7.74) + ((F.col("event_id") * 53) % 2400) / F.lit(10000.0)


def gps_events(events: DataFrame) -> DataFrame:
    """Typed GPS events of the ``events`` table: every tenth event is half an hour old on arrival."""
    late = F.col("event_id") % 10 == 0
    ts = _utc(F.col("ts"))
    speed = F.col("value") - 5
    return events.select(
        "event_id", F.col("event_id").alias("arrival"), F.col("user_id").alias("taxi_id"),
        F.when(late, ts - F.expr("interval 30 minutes")).otherwise(ts).alias("event_time"),
        _lat().alias("lat"), _lon().alias("lon"), speed.alias("speed"),
        F.when(F.col("event_type") == "error", "blackout").when(speed > 2, "moving")
        .otherwise("idle").alias("status"))


def gps_messages(events: DataFrame) -> DataFrame:
    """The same events as JSON messages, some in the other spelling, some broken."""
    g = gps_events(events)
    stamp = F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    eid = F.col("event_id").cast("string").alias("event_id")
    usual = F.to_json(F.struct(
        eid, "taxi_id", stamp.alias("timestamp_utc"), "lat", "lon", "speed", "status",
        F.col("arrival").alias("trip_id")))
    other = F.to_json(F.struct(
        eid, F.concat(F.lit("V"), F.col("taxi_id").cast("string")).alias("vehicle_id"),
        stamp.alias("timestamp"), F.col("lat").alias("latitude"), F.col("lon").alias("longitude")))
    undated = F.to_json(F.struct(eid, "taxi_id", "lat", "lon", "speed"))
    e = F.col("event_id")
    value = (
        F.when(e % 97 == 0, F.concat(F.lit('"'), e.cast("string"), F.lit('"')))
        .when(e % 89 == 0, undated).when(e % 83 == 0, other).otherwise(usual))
    return g.select("arrival", value.alias("value"))


GPS_SQL = """
gps AS (
  SELECT event_id, event_id AS arrival, user_id AS taxi_id,
         CASE WHEN event_id % 10 = 0 THEN ts - INTERVAL 30 MINUTE ELSE ts END AS event_time,
         CAST(33.46 AS DOUBLE) + CAST((event_id * 37) % 1800 AS DOUBLE) / 10000 AS lat,
         CAST(-7.74 AS DOUBLE) + CAST((event_id * 53) % 2400 AS DOUBLE) / 10000 AS lon,
         value - 5 AS speed,
         CASE WHEN event_type = 'error' THEN 'blackout' WHEN value - 5 > 2 THEN 'moving' ELSE 'idle' END AS status,
         event_type
  FROM events)"""

# What the parser must make of the messages.
PARSED_SQL = GPS_SQL + """,
parsed AS (
  SELECT arrival,
         CASE WHEN event_id % 97 = 0 THEN 'unknown' WHEN event_id % 89 = 0 THEN CAST(taxi_id AS VARCHAR)
              WHEN event_id % 83 = 0 THEN 'V' || taxi_id ELSE CAST(taxi_id AS VARCHAR) END AS taxi_id,
         CASE WHEN event_id % 97 = 0 OR event_id % 89 = 0 THEN NULL ELSE event_time END AS event_time,
         lat, lon,
         CASE WHEN event_id % 89 <> 0 AND event_id % 83 = 0 THEN CAST(0 AS DOUBLE) ELSE speed END AS speed,
         CASE WHEN event_id % 83 = 0 THEN 'unknown' ELSE status END AS status,
         CASE WHEN event_id % 97 = 0 OR event_id % 89 = 0 THEN 'missing_timestamp'
              WHEN event_id % 83 <> 0 AND speed < 0 THEN 'negative_speed' END AS reject_reason,
         event_id
  FROM gps),
capped AS (
  SELECT * REPLACE (CASE WHEN speed > 70 THEN CAST(20 AS DOUBLE) +
           CAST(CAST('0x' || substr(md5(CAST(event_id AS VARCHAR)), 1, 8) AS BIGINT) % 501 AS DOUBLE) / 10
         ELSE speed END AS speed)
  FROM parsed WHERE reject_reason IS NULL)"""


def grid_zone_sql(lat: str = "lat", lon: str = "lon") -> str:
    lo, hi = "CAST(-7.73 AS DOUBLE)", "CAST(-7.51 AS DOUBLE)"
    south, north = "CAST(33.47 AS DOUBLE)", "CAST(33.63 AS DOUBLE)"
    col = f"greatest(0, least(3, floor(({lon} - {lo}) / ({hi} - {lo}) * 4)))"
    row = f"greatest(0, least(3, floor(({north} - {lat}) / ({north} - {south}) * 4)))"
    return f"CAST({row} * 4 + {col} + 1 AS INTEGER)"


IN_BOX_SQL = ("lat BETWEEN CAST(33.47 AS DOUBLE) AND CAST(33.63 AS DOUBLE) AND "
              "lon BETWEEN CAST(-7.73 AS DOUBLE) AND CAST(-7.51 AS DOUBLE)")


def positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vehicle positions: events other than purchases, with their grid zone and true time."""
    e = table(spark, sf_dir, "events").filter(F.col("event_type") != "purchase")
    return e.select(
        "event_id", F.col("user_id").alias("taxi_id"), _utc(F.col("ts")).alias("event_time"),
        _lat().alias("lat"), _lon().alias("lon"),
        F.when(F.col("event_type") == "error", "blackout").otherwise("moving").alias("status"),
        geo.grid_zone(_lat(), _lon()).alias("zone_id"))


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trip requests: the purchases, placed a step away from the pings."""
    e = table(spark, sf_dir, "events").filter(F.col("event_type") == "purchase")
    return e.select(
        F.col("event_id").alias("request_id"), _utc(F.col("ts")).alias("event_time"),
        _lat().alias("lat"), _lon().alias("lon"), F.lit("requested").alias("status"),
        geo.grid_zone(_lat(), _lon()).alias("zone_id"))


MATCH_SQL = GPS_SQL.replace(
    "CASE WHEN event_id % 10 = 0 THEN ts - INTERVAL 30 MINUTE ELSE ts END AS event_time", "ts AS event_time"
) + f""",
positions AS (
  SELECT event_id, taxi_id, event_time, lat, lon,
         CASE WHEN event_type = 'error' THEN 'blackout' ELSE 'moving' END AS status,
         {grid_zone_sql()} AS zone_id
  FROM gps WHERE event_type <> 'purchase'),
requests AS (
  SELECT event_id AS request_id, event_time, lat, lon, 'requested' AS status, {grid_zone_sql()} AS zone_id
  FROM gps WHERE event_type = 'purchase')"""


def ride_hail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ride-hail records from ``events``: the value is the length in minutes."""
    e = table(spark, sf_dir, "events", "ts", "user_id", "value")
    pickup = _utc(F.col("ts"))
    seconds = F.floor(F.col("value") * 60)
    return e.select(
        pickup.alias("tpep_pickup_datetime"),
        F.timestamp_seconds(F.unix_timestamp(pickup) + seconds).alias("tpep_dropoff_datetime"),
        (F.col("user_id") % 16 + 1).cast("int").alias("PULocationID"))


RIDE_HAIL_SQL = """
ride_hail AS (
  SELECT ts AS tpep_pickup_datetime, CAST(user_id % 16 + 1 AS INTEGER) AS PULocationID,
         CAST(floor(value * 60) AS BIGINT) AS seconds
  FROM events)"""


def demand_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips with a zone and an epoch, dense in time, from ``events``."""
    e = table(spark, sf_dir, "events", "ts", "user_id")
    return e.select(
        (F.col("user_id") % 16 + 1).cast("int").alias("zone_id"),
        F.unix_timestamp(_utc(F.col("ts"))).alias("TIMESTAMP"))


DEMAND_SQL = """
demand AS (
  SELECT CAST(user_id % 16 + 1 AS INTEGER) AS zone_id,
         CAST(floor(epoch(ts)) AS BIGINT) // 1800 AS slot, count(*) AS demand
  FROM events GROUP BY ALL)"""


def order_demand_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips over many months, from ``orders``."""
    o = table(spark, sf_dir, "orders", "o_orderkey", "o_orderdate")
    return o.select(
        (F.col("o_orderkey") % 16 + 1).cast("int").alias("zone_id"),
        F.unix_timestamp(_utc(F.col("o_orderdate"))).alias("TIMESTAMP"))


ORDER_DEMAND_SQL = """
demand AS (
  SELECT CAST(o_orderkey % 16 + 1 AS INTEGER) AS zone_id,
         CAST(epoch(o_orderdate) AS BIGINT) // 1800 AS slot, count(*) AS demand
  FROM orders GROUP BY ALL)"""


# --- zones from nation -----------------------------------------------------------------------------
# Polygon templates in steps of 0.0001 degree from the corner of a district: kind, part, ring, points.
# kind 0: diamond; 1: two parts; 2: square with a hole; 3: wide box that overlaps its neighbours.
SHAPES = [
    (0, 0, 0, [(240, 0), (480, 180), (240, 360), (0, 180), (240, 0)]),
    (1, 0, 0, [(0, 0), (220, 0), (220, 360), (0, 360), (0, 0)]),
    (1, 1, 0, [(300, 0), (480, 0), (400, 360), (300, 0)]),
    (2, 0, 0, [(0, 0), (480, 0), (480, 360), (0, 360), (0, 0)]),
    (2, 0, 1, [(100, 100), (300, 100), (300, 250), (100, 250), (100, 100)]),
    (3, 0, 0, [(-60, -40), (540, -40), (540, 300), (200, 400), (-60, 300), (-60, -40)]),
]
_WEST, _SOUTH = 77400, 334600  # 1e-4 degree; longitude is west of Greenwich


def _coordinate(steps: Column) -> Column:
    return F.concat((F.floor(steps / 10000)).cast("string"), F.lit("."), _padded(steps % 10000, 4))


def zone_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """GeoJSON features, one per nation in a 5x5 pattern, as parsed from their JSON text."""
    n = table(spark, sf_dir, "nation", "n_nationkey", "n_name")
    key = F.col("n_nationkey").cast("bigint")
    x0, y0 = F.lit(_WEST) - (key % 5) * 480, F.lit(_SOUTH) + F.floor(key / 5) * 360

    def ring(points) -> Column:
        pairs = [F.concat(F.lit("[-"), _coordinate(x0 - dx), F.lit(","), _coordinate(y0 + dy), F.lit("]"))
                 for dx, dy in points]
        return F.concat(F.lit("["), F.concat_ws(",", *pairs), F.lit("]"))

    def polygon(kind: int, part: int) -> Column:
        rings = [ring(points) for k, p, _, points in SHAPES if (k, p) == (kind, part)]
        return F.concat(F.lit("["), F.concat_ws(",", *rings), F.lit("]"))

    kind = key % 4
    coordinates = (
        F.when(kind == 0, polygon(0, 0))
        .when(kind == 1, F.concat(F.lit("["), polygon(1, 0), F.lit(","), polygon(1, 1), F.lit("]")))
        .when(kind == 2, polygon(2, 0)).otherwise(polygon(3, 0)))
    name = F.concat(F.lit("arrondissement d'"), F.col("n_name"), F.lit(" (zone)"))
    zone_id = F.when(key % 3 == 0, F.concat(F.lit("Z"), key.cast("string"))).otherwise(
        (key + 101).cast("string"))
    geojson = F.concat(
        F.lit('{"type":"Feature","properties":{"NOM":"'), F.when(key == 24, "Mechouar Casablanca").otherwise(name),
        F.lit('","id":"'), zone_id, F.lit('","PREFECTURE":"P'), (key % 5).cast("string"),
        F.lit('","Population":'), (key * 1000 + 500).cast("string"),
        F.lit('},"geometry":{"type":"'), F.when(kind == 1, "MultiPolygon").otherwise("Polygon"),
        F.lit('","coordinates":'), coordinates, F.lit("}}"))
    return n.select(key.alias("position"), F.inline(F.array(F.from_json(geojson, schemas.GEO_FEATURE))))


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    return zone_dimension(zone_features(spark, sf_dir))


def zone_lookup(spark: SparkSession, sf_dir: str) -> ZoneLookup:
    return ZoneLookup(zones(spark, sf_dir))


_VERTICES = ", ".join(
    f"({k}, {p}, {r}, {i}, {dx}, {dy})"
    for k, p, r, points in SHAPES for i, (dx, dy) in enumerate(points))

ZONES_SQL = f"""
shapes(kind, part, ring, i, dx, dy) AS (VALUES {_VERTICES}),
kept AS (
  SELECT CAST(n_nationkey AS BIGINT) AS key, n_name, row_number() OVER (ORDER BY n_nationkey) AS seq
  FROM nation WHERE n_nationkey <> 24),
vertices AS (
  SELECT seq, key, part, ring, i,
         -CAST({_WEST} - (key % 5) * 480 - dx AS DOUBLE) / 10000 AS x,
         CAST({_SOUTH} + (key // 5) * 360 + dy AS DOUBLE) / 10000 AS y
  FROM kept JOIN shapes ON kind = key % 4),
zones AS (
  SELECT k.seq, CAST(CASE WHEN k.key % 3 = 0 THEN k.seq ELSE k.key + 101 END AS INTEGER) AS zone_id,
         n_name AS name, 'P' || (k.key % 5) AS prefecture, CAST(k.key * 1000 + 500 AS VARCHAR) AS population,
         avg(x) AS centroid_lon, avg(y) AS centroid_lat
  FROM kept k JOIN vertices v ON k.seq = v.seq GROUP BY ALL),
box AS (SELECT min(x) AS min_lon, max(x) AS max_lon, min(y) AS min_lat, max(y) AS max_lat FROM vertices),
edges AS (
  SELECT seq, part, ring, x, y,
         coalesce(lag(x) OVER w, last_value(x) OVER f) AS px, coalesce(lag(y) OVER w, last_value(y) OVER f) AS py
  FROM vertices
  WINDOW w AS (PARTITION BY seq, part, ring ORDER BY i),
         f AS (PARTITION BY seq, part, ring ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))"""


def containment_sql(points: str) -> str:
    """CTEs that give (id, seq) of the first zone holding each point of ``points`` (id, lat, lon)."""
    return f"""
crossings AS (
  SELECT p.id, e.seq, e.part, e.ring, count(*) % 2 = 1 AS inside
  FROM {points} p JOIN edges e ON (e.y > p.lat) <> (e.py > p.lat)
   AND p.lon < (e.px - e.x) * (p.lat - e.y) / (e.py - e.y) + e.x
  GROUP BY ALL),
containing AS (
  SELECT id, min(seq) AS seq FROM (
    SELECT id, seq, part FROM crossings GROUP BY ALL
    HAVING bool_or(inside AND ring = 0) AND NOT bool_or(inside AND ring > 0))
  GROUP BY id),
nearest AS (
  SELECT id, arg_min(seq, d2) AS seq FROM (
    SELECT p.id, z.seq, (p.lon - z.centroid_lon) * (p.lon - z.centroid_lon)
                      + (p.lat - z.centroid_lat) * (p.lat - z.centroid_lat) AS d2
    FROM {points} p, zones z WHERE p.id NOT IN (SELECT id FROM containing))
  GROUP BY id)"""
