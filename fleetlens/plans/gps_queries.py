"""GPS cleaning, zones, lateness."""

from __future__ import annotations

from pyspark.sql import functions as F

from fleetlens import constants as K
from fleetlens.functions import text
from fleetlens.operators import curate, gps, lateness, trajectory
from fleetlens.plans import bindings as b
from fleetlens.plans.registry import plain_times, query, r6
from fleetlens.session import scratch_path
from fleetlens.sources import serving, zones as zs


def parsed(spark, sf_dir):
    return gps.parse_gps(b.gps_messages(b.table(spark, sf_dir, "events")))


@query(f"""WITH {b.PARSED_SQL}
SELECT arrival, taxi_id, event_time, round(lat, 6) AS lat, round(lon, 6) AS lon, round(speed, 6) AS speed, status
FROM parsed WHERE reject_reason IS NULL""")
def parse_gps(spark, sf_dir):
    good = parsed(spark, sf_dir).filter(F.col("reject_reason").isNull())
    return plain_times(good.select(
        "arrival", "taxi_id", "event_time", r6("lat"), r6("lon"), r6("speed"), "status"), "event_time")


@query(f"WITH {b.PARSED_SQL} SELECT reject_reason, count(*) AS n FROM parsed WHERE reject_reason IS NOT NULL GROUP BY 1")
def gps_rejects(spark, sf_dir):
    return gps.rejects(parsed(spark, sf_dir)).groupBy("reject_reason").agg(F.count(F.lit(1)).alias("n"))


@query(f"""WITH {b.PARSED_SQL}
SELECT 'Casablanca' AS city, {b.grid_zone_sql()} AS zone_id, arrival, taxi_id, event_time,
       round(lat, 6) AS lat, round(lon, 6) AS lon, round(speed, 6) AS speed, status
FROM capped WHERE {b.IN_BOX_SQL}""")
def normalize_grid(spark, sf_dir):
    out = gps.normalize(parsed(spark, sf_dir), gps.GRID)
    return plain_times(out.select(
        "city", "zone_id", "arrival", "taxi_id", "event_time", r6("lat"), r6("lon"), r6("speed"), "status"),
        "event_time")


_PLACED_SQL = b.PARSED_SQL + "," + b.ZONES_SQL + """,
inbox AS (
  SELECT arrival AS id, c.* FROM capped c, box
  WHERE lat BETWEEN min_lat - CAST(0.01 AS DOUBLE) AND max_lat + CAST(0.01 AS DOUBLE)
    AND lon BETWEEN min_lon - CAST(0.01 AS DOUBLE) AND max_lon + CAST(0.01 AS DOUBLE)),""" + b.containment_sql("inbox")

_POLYGON_SQL = f"""WITH {_PLACED_SQL}
SELECT 'Casablanca' AS city, z.zone_id, z.name AS arrondissement, z.prefecture, z.population AS zone_population,
       event_time, taxi_id, arrival, round(lat, 6) AS lat, round(lon, 6) AS lon, round(speed, 6) AS speed, status
FROM inbox i JOIN (SELECT * FROM containing UNION ALL SELECT * FROM nearest) c ON c.id = i.id
JOIN zones z ON z.seq = c.seq"""


@query(_POLYGON_SQL)
def normalize_polygon(spark, sf_dir):
    out = gps.normalize(parsed(spark, sf_dir), gps.POLYGON, b.zone_lookup(spark, sf_dir))
    return plain_times(out.select(
        "city", "zone_id", "arrondissement", "prefecture", "zone_population", "event_time", "taxi_id",
        "arrival", r6("lat"), r6("lon"), r6("speed"), "status"), "event_time")


@query(f"""WITH {_PLACED_SQL}
SELECT 'Casablanca' AS city, z.zone_id, z.name AS arrondissement, event_time, taxi_id, arrival, status
FROM inbox i JOIN containing c ON c.id = i.id JOIN zones z ON z.seq = c.seq""")
def normalize_polygon_strict(spark, sf_dir):
    out = gps.normalize(parsed(spark, sf_dir), gps.POLYGON_STRICT, b.zone_lookup(spark, sf_dir))
    return plain_times(out.select(
        "city", "zone_id", "arrondissement", "event_time", "taxi_id", "arrival", "status"), "event_time")


@query(f"""WITH {_PLACED_SQL}
SELECT z.zone_id, 'arrondissement d''' || z.name || ' (zone)' AS arrondissement, z.prefecture,
       z.population AS zone_population, arrival
FROM inbox i JOIN (SELECT * FROM containing UNION ALL SELECT * FROM nearest) c ON c.id = i.id
JOIN zones z ON z.seq = c.seq""")
def normalize_polygon_raw_names(spark, sf_dir):
    lookup = gps.ZoneLookup(zs.zone_dimension(b.zone_features(spark, sf_dir), clean_names=False))
    out = gps.normalize(parsed(spark, sf_dir), gps.POLYGON_RAW_NAMES, lookup)
    return out.select("zone_id", "arrondissement", "prefecture", "zone_population", "arrival")


@query(f"""WITH {b.ZONES_SQL}
SELECT CAST(seq AS INTEGER) AS seq, zone_id, name, prefecture, population,
       round(centroid_lon, 6) AS centroid_lon, round(centroid_lat, 6) AS centroid_lat FROM zones""")
def zone_dimension(spark, sf_dir):
    return b.zones(spark, sf_dir).select(
        "seq", "zone_id", "name", "prefecture", "population", r6("centroid_lon"), r6("centroid_lat"))


@query(f"WITH {b.ZONES_SQL} SELECT min_lon, max_lon, min_lat, max_lat FROM box")
def zone_bounding_box(spark, sf_dir):
    return zs.bounding_box(b.zones(spark, sf_dir))


@query(f"""WITH {_PLACED_SQL}
SELECT z.zone_id, count(*) AS points
FROM inbox i JOIN (SELECT * FROM containing UNION ALL SELECT * FROM nearest) c ON c.id = i.id
JOIN zones z ON z.seq = c.seq GROUP BY 1""")
def points_per_zone(spark, sf_dir):
    return gps.points_per_zone(
        gps.normalize(parsed(spark, sf_dir), gps.POLYGON, b.zone_lookup(spark, sf_dir)))


@query(f"""WITH {b.GPS_SQL}
SELECT CAST(floor(lat / CAST(0.01 AS DOUBLE)) AS BIGINT) AS lat_cell,
       CAST(floor(lon / CAST(0.01 AS DOUBLE)) AS BIGINT) AS lon_cell, count(*) AS points
FROM gps GROUP BY ALL""")
def density_heatmap(spark, sf_dir):
    return trajectory.density(b.gps_events(b.table(spark, sf_dir, "events")))


_ZONE_POINTS_SQL = ", ".join(f"({z}, {lat}, {lon})" for z, (lat, lon) in K.ZONE_POINTS.items())


@query(f"""WITH {b.DEMAND_SQL},
zone_points(zone_id, lat, lon) AS (VALUES {_ZONE_POINTS_SQL})
SELECT d.zone_id, sum(demand)::BIGINT AS trips, CAST(coalesce(any_value(lat), 33.5731) AS DOUBLE) AS zone_lat,
       CAST(coalesce(any_value(lon), -7.5898) AS DOUBLE) AS zone_lon
FROM demand d LEFT JOIN zone_points p ON p.zone_id = d.zone_id GROUP BY 1""")
def zone_points(spark, sf_dir):
    per_zone = b.demand_trips(spark, sf_dir).groupBy("zone_id").agg(F.count(F.lit(1)).alias("trips"))
    return gps.representative_points(per_zone)


@query(f"""SELECT CAST(l_orderkey % 16 + 1 AS INTEGER) AS zone_id, count(*) AS points,
       any_value('g_' || CAST(floor((CAST(33.5 AS DOUBLE) + (l_orderkey % 16 + 1) * CAST(0.01 AS DOUBLE)) / CAST(0.005 AS DOUBLE)) AS BIGINT)
       || '_' || CAST(floor((CAST(-7.6 AS DOUBLE) + (l_orderkey % 16 + 1) * CAST(0.01 AS DOUBLE)) / CAST(0.005 AS DOUBLE)) AS BIGINT)) AS cell_id
FROM lineitem GROUP BY 1""")
def zone_cells(spark, sf_dir):
    per_zone = b.table(spark, sf_dir, "lineitem", "l_orderkey").groupBy(
        (F.col("l_orderkey") % 16 + 1).cast("int").alias("zone_id")).agg(F.count(F.lit(1)).alias("points"))
    return per_zone.join(F.broadcast(curate.cell_dimension(spark)), "zone_id", "left")


@query(f"""WITH {b.GPS_SQL},
labelled AS (
  SELECT CASE event_id % 7 WHEN 0 THEN 'moving' WHEN 1 THEN 'idle' WHEN 2 THEN 'blackout_recovered'
         WHEN 3 THEN 'blackout' WHEN 4 THEN NULL ELSE event_type END AS s FROM gps)
SELECT CASE s WHEN 'moving' THEN '🚕 MOVING' WHEN 'idle' THEN '🅿️  IDLE'
       WHEN 'blackout_recovered' THEN '⚠️  BLACKOUT RECOVERED' WHEN 'blackout' THEN '🔴 BLACKOUT'
       ELSE '[' || upper(coalesce(s, 'unknown')) || ']' END AS label, count(*) AS n
FROM labelled GROUP BY 1""")
def status_labels(spark, sf_dir):
    e = b.table(spark, sf_dir, "events", "event_id", "event_type")
    k = F.col("event_id") % 7
    status = (
        F.when(k == 0, "moving").when(k == 1, "idle").when(k == 2, "blackout_recovered")
        .when(k == 3, "blackout").when(k == 4, F.lit(None)).otherwise(F.col("event_type")))
    return e.groupBy(text.status_label(status).alias("label")).agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT CASE event_id % 4 WHEN 0 THEN 'demand_spike' WHEN 1 THEN 'rain_event' ELSE 'normal' END AS label,
count(*) AS n FROM events GROUP BY 1""")
def anomaly_labels(spark, sf_dir):
    e = b.table(spark, sf_dir, "events", "event_id")
    k = F.col("event_id") % 4
    anomaly = F.when(k == 0, "demand_spike").when(k == 1, "rain_event").when(k == 2, "")
    return e.groupBy(text.anomaly_label(anomaly).alias("label")).agg(F.count(F.lit(1)).alias("n"))


@query(f"""WITH {b.PARSED_SQL}
SELECT taxi_id, event_time, round(lat, 6) AS lat, round(lon, 6) AS lon
FROM capped WHERE {b.IN_BOX_SQL} AND {b.grid_zone_sql()} = 7
ORDER BY event_time DESC, taxi_id, lat, lon LIMIT 10""")
def latest_positions(spark, sf_dir):
    """Through a table partitioned by city and zone."""
    path = scratch_path(spark, "positions")
    gps.output_fields(gps.normalize(parsed(spark, sf_dir), gps.GRID)).write.partitionBy(
        "city", "zone_id").parquet(path)
    rows = gps.latest_positions(spark.read.parquet(path), K.CITY, 7)
    return plain_times(rows.select("taxi_id", "event_time", r6("lat"), r6("lon")), "event_time")


_LATE_SQL = f"""{b.PARSED_SQL},
kept AS (SELECT * FROM capped WHERE {b.IN_BOX_SQL}),
seen AS (
  SELECT *, epoch_us(event_time) // 1000 AS ms,
         max(epoch_us(event_time) // 1000) OVER (ORDER BY arrival ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before
  FROM kept),
judged AS (SELECT *, coalesce(before - 180001 > 0 AND ms < before - 180001, FALSE) AS is_late FROM seen)"""


@query(f"""WITH {_LATE_SQL}
SELECT arrival, taxi_id, event_time, is_late, before AS max_before_ms,
       CASE WHEN is_late THEN CAST((before - 180001 - ms) // 1000 AS BIGINT) END AS late_by_sec FROM judged""")
def flag_late(spark, sf_dir):
    flagged = lateness.flag_late(gps.normalize(parsed(spark, sf_dir), gps.GRID))
    return plain_times(flagged.select(
        "arrival", "taxi_id", "event_time", "is_late", "max_before_ms", "late_by_sec"), "event_time")


@query(f"""WITH {_LATE_SQL.replace("OVER (ORDER BY arrival", "OVER (PARTITION BY arrival % 3 ORDER BY arrival")}
SELECT arrival % 3 AS source, count(*) AS n, count(*) FILTER (is_late) AS late FROM judged GROUP BY 1""")
def late_per_source(spark, sf_dir):
    """One watermark per source partition."""
    events = gps.normalize(parsed(spark, sf_dir), gps.GRID).withColumn("source", F.col("arrival") % 3)
    return lateness.flag_late(events, sources=["source"]).groupBy("source").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("is_late").alias("late"))


@query("""SELECT l_orderkey AS event_id, l_linenumber, l_partkey, l_suppkey FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) = 1""")
def one_row_per_event(spark, sf_dir):
    e = b.table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey") \
        .withColumnRenamed("l_orderkey", "event_id")
    return lateness.one_row_per_event(e)


@query(f"""WITH {b.GPS_SQL}
SELECT count(*) AS sent, count(*) FILTER (event_id % 13 = 0 AND status = 'moving') AS recovered_blackouts,
       count(*) FILTER (status = 'blackout') AS blackout_pings FROM gps""")
def publish_counters(spark, sf_dir):
    recovered = (F.col("event_id") % 13 == 0) & (F.col("status") == "moving")
    events = b.gps_events(b.table(spark, sf_dir, "events")).withColumn(
        "status", F.when(recovered, "blackout_recovered").otherwise(F.col("status")))
    return events.agg(*gps.counters())


@query(f"""WITH {b.PARSED_SQL}
SELECT taxi_id, max(event_time) AS event_time, arg_max({b.grid_zone_sql()}, (event_time, arrival)) AS zone_id
FROM capped WHERE {b.IN_BOX_SQL} GROUP BY 1""")
def vehicle_positions(spark, sf_dir):
    """Newest position per taxi in a serving table, loaded in two parts."""
    path = scratch_path(spark, "vehicles")
    rows = gps.normalize(parsed(spark, sf_dir), gps.GRID).select(
        "taxi_id", "event_time", "arrival", "zone_id", serving.key_bucket("taxi_id", buckets=4).alias("bucket"))
    half = b.table(spark, sf_dir, "events").agg((F.max("event_id") / 2).alias("h")).scalar()
    for part in (F.col("arrival") <= half, F.col("arrival") > half):
        serving.merge_by_key(rows.filter(part), path, ["taxi_id"], ["event_time", "arrival"], ["bucket"])
    return plain_times(spark.read.parquet(path).select("taxi_id", "event_time", "zone_id"), "event_time")
