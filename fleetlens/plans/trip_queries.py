"""Curation, KPIs and exploration."""

from __future__ import annotations

from pyspark.sql import functions as F

from fleetlens import schemas
from fleetlens.functions import timing, trips as tf
from fleetlens.operators import curate, explore, kpi
from fleetlens.plans import bindings as b
from fleetlens.plans.registry import plain_times, query, r6
from fleetlens.session import scratch_path
from fleetlens.sources import files, serving

CURATED_SQL = b.RAW_TRIPS_SQL + """,
curated AS (
  SELECT *, n_points * 15 AS trip_duration_sec, CAST(o_orderkey % 16 + 1 AS INTEGER) AS zone_id
  FROM raw_trips WHERE n_points >= 1)"""

_CELL_SQL = """'g_' || CAST(floor((CAST(33.5 AS DOUBLE) + zone_id * CAST(0.01 AS DOUBLE)) / CAST(0.005 AS DOUBLE)) AS BIGINT)
 || '_' || CAST(floor((CAST(-7.6 AS DOUBLE) + zone_id * CAST(0.01 AS DOUBLE)) / CAST(0.005 AS DOUBLE)) AS BIGINT)"""


def curated(spark, sf_dir):
    return curate.curate_trips(b.raw_trips(spark, sf_dir), zone=tf.key_zone)


@query(f"WITH {CURATED_SQL} SELECT TRIP_ID, CAST(trip_duration_sec AS INTEGER) AS trip_duration_sec, zone_id, "
       f"{_CELL_SQL} AS cell_id, POLYLINE FROM curated")
def curate_trips(spark, sf_dir):
    return curated(spark, sf_dir).select("TRIP_ID", "trip_duration_sec", "zone_id", "cell_id", "POLYLINE")


@query()
def curate_hash_zone(spark, sf_dir):
    return curate.curate_trips(b.raw_trips(spark, sf_dir)).groupBy("zone_id").agg(
        F.count(F.lit(1)).alias("trips"), F.avg("trip_duration_sec").alias("avg_duration"))


@query(f'WITH {b.REPEATED_TRIPS_SQL} SELECT TRIP_ID, "TIMESTAMP", POLYLINE FROM repeated_trips '
       'QUALIFY row_number() OVER (PARTITION BY TRIP_ID ORDER BY TRY_CAST("TIMESTAMP" AS BIGINT), "TIMESTAMP", POLYLINE) = 1')
def one_row_per_trip(spark, sf_dir):
    return curate.one_row_per_trip(b.repeated_trips(spark, sf_dir))


@query(f"""WITH {b.RAW_TRIPS_SQL}
SELECT count(*) AS raw_rows, count(POLYLINE) AS with_polyline,
       count(*) FILTER (n_points >= 1) AS usable_rows,
       count(DISTINCT TRIP_ID) FILTER (n_points >= 1) AS curated_rows
FROM raw_trips""")
def stage_counts(spark, sf_dir):
    return curate.stage_counts(b.raw_trips(spark, sf_dir))


@query(f"WITH {CURATED_SQL} SELECT zone_id, count(*) AS trips FROM curated GROUP BY zone_id")
def kpi_trips_per_zone(spark, sf_dir):
    return kpi.trips_per_zone(curated(spark, sf_dir))


@query(f"WITH {CURATED_SQL} SELECT round(avg(trip_duration_sec) / 60, 6) AS avg_minutes FROM curated")
def kpi_average_minutes(spark, sf_dir):
    return kpi.average_minutes(curated(spark, sf_dir)).select(r6("avg_minutes"))


@query(f"""WITH {b.RIDE_HAIL_SQL}
SELECT CAST(hour(tpep_pickup_datetime) AS INTEGER) AS hour, count(*) AS demand FROM ride_hail GROUP BY 1""")
def kpi_peak_hours(spark, sf_dir):
    return kpi.peak_hours(b.ride_hail(spark, sf_dir))


@query(f"""WITH {CURATED_SQL}
SELECT zone_id, count(*) AS trips, round(avg(trip_duration_sec), 6) AS avg_duration FROM curated GROUP BY zone_id""")
def kpi_zone_summary(spark, sf_dir):
    return kpi.zone_summary(curated(spark, sf_dir)).select("zone_id", "trips", r6("avg_duration"))


@query(f"""WITH {CURATED_SQL}
SELECT zone_id, count(*) AS trips, round(avg(trip_duration_sec), 6) AS avg_duration FROM curated GROUP BY zone_id""")
def kpi_zone_summary_sql(spark, sf_dir):
    curated(spark, sf_dir).createOrReplaceTempView("curated_trips")
    return spark.sql("""
        SELECT zone_id, COUNT(*) AS trips, ROUND(AVG(trip_duration_sec), 6) AS avg_duration
        FROM curated_trips GROUP BY zone_id""")


@query(f"""WITH {b.RIDE_HAIL_SQL}
SELECT PULocationID, count(*) AS trip_count, round(avg(seconds / 60), 6) AS avg_duration_min
FROM ride_hail GROUP BY 1""")
def pickup_zone_demand(spark, sf_dir):
    return kpi.pickup_zone_demand(b.ride_hail(spark, sf_dir)).select(
        "PULocationID", "trip_count", r6("avg_duration_min"))


@query(f"WITH {CURATED_SQL} SELECT zone_id, count(*) AS demand, 1 AS vehicles FROM curated GROUP BY zone_id")
def coverage_gap_const(spark, sf_dir):
    return kpi.coverage_gap_const(curated(spark, sf_dir))


@query(f"""WITH {b.MATCH_SQL},
wanted AS (SELECT zone_id, date_trunc('hour', event_time) AS hour, count(*) AS demand FROM requests GROUP BY ALL),
active AS (SELECT zone_id, date_trunc('hour', event_time) AS hour, count(DISTINCT taxi_id) AS vehicles
           FROM positions WHERE status <> 'blackout' GROUP BY ALL)
SELECT w.zone_id, w.hour, demand, coalesce(vehicles, 0) AS vehicles
FROM wanted w LEFT JOIN active a ON w.zone_id = a.zone_id AND w.hour = a.hour WHERE coalesce(vehicles, 0) < 2""")
def coverage_gap(spark, sf_dir):
    hour = F.date_trunc("hour", "event_time")
    gap = kpi.coverage_gap(
        b.requests(spark, sf_dir).withColumn("hour", hour),
        b.positions(spark, sf_dir).withColumn("hour", hour), keys=("zone_id", "hour"))
    return plain_times(gap, "hour")


# --- sinks that are read back ---------------------------------------------------------------

@query(f"""WITH {CURATED_SQL}
SELECT TRIP_ID, CAST(trip_duration_sec AS INTEGER) AS trip_duration_sec, zone_id, DAY_TYPE FROM curated""")
def csv_curate(spark, sf_dir):
    """Through a CSV file: all text, polylines with commas quoted."""
    path = scratch_path(spark, "trips-csv")
    raw = b.raw_trips(spark, sf_dir).select(*schemas.RAW_TRIP.fieldNames())
    files.write_trips_csv(raw, path)
    return curate.curate_trips(files.read_trips_csv(spark, path), zone=tf.key_zone).select(
        "TRIP_ID", "trip_duration_sec", "zone_id", "DAY_TYPE")


@query(f"""WITH {CURATED_SQL}
SELECT zone_id, TRIP_ID, CAST(trip_duration_sec AS INTEGER) AS trip_duration_sec FROM curated
ORDER BY o_orderkey LIMIT 1000""")
def sample_sink(spark, sf_dir):
    path = scratch_path(spark, "sample")
    numbered = curated(spark, sf_dir).withColumn("k", F.col("TRIP_ID").cast("bigint"))
    files.write_sample(numbered, path, ["k"])
    return spark.read.parquet(path).select("zone_id", "TRIP_ID", "trip_duration_sec")


@query(f"""WITH {CURATED_SQL}
SELECT CAST(TRIP_ID AS BIGINT) AS trip, zone_id FROM curated ORDER BY trip LIMIT 10""")
def sample_read(spark, sf_dir):
    trips = curated(spark, sf_dir).select(F.col("TRIP_ID").cast("bigint").alias("trip"), "zone_id")
    return explore.first_rows(trips, ["trip"], 10)


@query(f"""WITH {b.RIDE_HAIL_SQL}
SELECT CAST(hour(tpep_pickup_datetime) AS INTEGER) AS hour, count(*) AS trips FROM ride_hail GROUP BY 1""")
def peak_hours_table(spark, sf_dir):
    """Truncate and load, twice."""
    path = scratch_path(spark, "peak-hours")
    hours = kpi.peak_hours(b.ride_hail(spark, sf_dir), name="trips")
    serving.replace_table(hours, path)
    serving.replace_table(hours, path)
    return spark.read.parquet(path)


@query(f"""WITH {CURATED_SQL}
SELECT zone_id, count(*) AS trips, round(avg(trip_duration_sec), 6) AS avg_duration FROM curated GROUP BY zone_id""")
def serving_upsert(spark, sf_dir):
    """First the trips of call type A, then all of them: the second load replaces the rows of its keys."""
    path = scratch_path(spark, "demand-zones")
    trips = curated(spark, sf_dir)
    for version, rows in ((1, trips.filter(F.col("CALL_TYPE") == "A")), (2, trips), (2, trips)):
        summary = kpi.zone_summary(rows).select(
            "trips", r6("avg_duration"), F.lit(version).alias("version"), "zone_id")
        serving.merge_by_key(summary, path, ["zone_id"], ["version"], ["zone_id"])
    return spark.read.parquet(path).select("zone_id", "trips", "avg_duration")


# --- exploration -------------------------------------------------------------------------------

@query(f"WITH {b.RAW_TRIPS_SQL} SELECT DAY_TYPE, count(*) AS trips FROM raw_trips GROUP BY 1")
def trips_by_day_type(spark, sf_dir):
    return explore.trips_by_day_type(b.raw_trips(spark, sf_dir))


@query(f"WITH {b.RAW_TRIPS_SQL} SELECT CALL_TYPE, count(*) AS trips FROM raw_trips GROUP BY 1")
def trips_by_call_type(spark, sf_dir):
    return explore.trips_by_call_type(b.raw_trips(spark, sf_dir))


@query(f"WITH {b.RAW_TRIPS_SQL} SELECT TAXI_ID, count(*) AS trips FROM raw_trips GROUP BY 1 "
       "ORDER BY trips DESC, TAXI_ID LIMIT 10")
def busiest_taxis(spark, sf_dir):
    return explore.busiest_taxis(b.raw_trips(spark, sf_dir))


@query(f"WITH {b.RAW_TRIPS_SQL} SELECT TAXI_ID, count(*) AS trips FROM raw_trips GROUP BY 1 "
       "ORDER BY trips, TAXI_ID LIMIT 10")
def quietest_taxis(spark, sf_dir):
    return explore.quietest_taxis(b.raw_trips(spark, sf_dir))


@query("SELECT CAST(hour(ts) AS INTEGER) AS hour, count(*) AS trips FROM events GROUP BY 1")
def trips_per_hour(spark, sf_dir):
    return explore.trips_per_hour(b.demand_trips(spark, sf_dir))


@query(f"""WITH {b.RAW_TRIPS_SQL},
days(day_number, day_name) AS (VALUES (1, 'Monday'), (2, 'Tuesday'), (3, 'Wednesday'), (4, 'Thursday'),
  (5, 'Friday'), (6, 'Saturday'), (7, 'Sunday')),
counts AS (SELECT dayname(o_orderdate) AS day_name, count(*) AS trips FROM orders GROUP BY 1)
SELECT day_number, d.day_name, trips FROM days d LEFT JOIN counts c ON d.day_name = c.day_name""")
def trips_per_weekday(spark, sf_dir):
    return explore.trips_per_weekday(b.raw_trips(spark, sf_dir))


_HISTOGRAM_SQL = """
bounds AS (SELECT CAST(min(duration) AS DOUBLE) AS lo, CAST(max(duration) AS DOUBLE) AS hi FROM d),
filled AS (
  SELECT CAST(coalesce(least(floor((duration - lo) / nullif((hi - lo) / 50, 0)), 49), 0) AS INTEGER) AS bin,
         count(*) AS n
  FROM d, bounds WHERE duration IS NOT NULL GROUP BY 1)
SELECT CAST(g.bin AS INTEGER) AS bin, round(lo + g.bin * ((hi - lo) / 50), 6) AS bin_start,
       round(lo + (g.bin + 1) * ((hi - lo) / 50), 6) AS bin_end, coalesce(n, 0) AS trips
FROM range(50) g(bin) CROSS JOIN bounds LEFT JOIN filled f ON f.bin = g.bin"""


@query(f"""WITH {b.RAW_TRIPS_SQL}, d AS (SELECT n_points * 15 AS duration FROM raw_trips), {_HISTOGRAM_SQL}""")
def duration_histogram(spark, sf_dir):
    points = tf.parse_polyline(F.col("POLYLINE"))
    durations = b.raw_trips(spark, sf_dir).select(tf.duration_from_points(points).alias("duration"))
    return explore.duration_histogram(durations).select("bin", r6("bin_start"), r6("bin_end"), "trips")


@query(f"""WITH {b.RIDE_HAIL_SQL}, d AS (SELECT seconds AS duration FROM ride_hail), {_HISTOGRAM_SQL}""")
def ride_histogram(spark, sf_dir):
    seconds = (F.unix_timestamp("tpep_dropoff_datetime") - F.unix_timestamp("tpep_pickup_datetime"))
    rides = b.ride_hail(spark, sf_dir).select(seconds.alias("duration"))
    return explore.duration_histogram(rides).select("bin", r6("bin_start"), r6("bin_end"), "trips")


@query(f"""WITH {b.RAW_TRIPS_SQL}
SELECT TRIP_ID, TAXI_ID FROM raw_trips ORDER BY md5(TRIP_ID || ':42'), TRIP_ID LIMIT 500""")
def sample_trips(spark, sf_dir):
    return explore.sample_trips(b.raw_trips(spark, sf_dir)).select("TRIP_ID", "TAXI_ID")


@query("""WITH curve AS (SELECT [0.2, 0.15, 0.1, 0.1, 0.15, 0.3, 0.7, 1.5, 2.5, 1.8, 1.0, 0.8,
  0.7, 0.6, 0.7, 0.9, 1.2, 2.0, 2.8, 2.0, 1.3, 1.0, 0.7, 0.4]::DOUBLE[] AS c),
rated AS (SELECT hour(ts) AS hour, dayofweek(ts) = 5 AS friday,
  c[hour(ts) + 1] * CASE WHEN dayofweek(ts) = 5 AND hour(ts) >= 12 AND hour(ts) < 14 THEN 0.5::DOUBLE ELSE 1::DOUBLE END
    AS multiplier FROM events, curve)
SELECT CAST(hour AS INTEGER) AS hour, friday, count(*) AS requests, round(max(multiplier), 6) AS multiplier,
  round(max(3600 / greatest(0.05::DOUBLE, 30::DOUBLE / multiplier)), 6) AS expected_per_hour
FROM rated GROUP BY 1, 2""")
def demand_curve(spark, sf_dir):
    ts = F.col("ts")
    rated = b.table(spark, sf_dir, "events", "ts").select(
        F.hour(ts).alias("hour"), (F.dayofweek(ts) == 6).alias("friday"),
        timing.demand_multiplier(ts).alias("multiplier"))
    return rated.groupBy("hour", "friday").agg(
        F.count(F.lit(1)).alias("requests"), r6(F.max("multiplier")).alias("multiplier"),
        r6(F.max(timing.requests_per_hour(F.col("multiplier")))).alias("expected_per_hour"))
