"""Streams over the supplied tables: each table file arrives, is drained, and the sink is read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from fleetlens.operators import gps, lifecycle
from fleetlens.plans import bindings as b, demand_queries as dq, gps_queries as gq
from fleetlens.plans.registry import plain_times, query, r6
from fleetlens.session import scratch_path, use_utc
from fleetlens.streaming import io, jobs, timers
from fleetlens.streaming.normalizer import GpsSinks, LateFilter, SourceWatermark, normalized_stream


def arriving(spark, sf_dir, name):
    """A table as a stream of its files."""
    use_utc(spark)
    file = f"{name}.parquet"
    schema = spark.read.parquet(f"{sf_dir}/{file}").schema
    return io.read_files(spark, sf_dir, schema, pathGlobFilter=file)


BATCHES = 5


def _through_sinks(spark, sf_dir, lookup=None, options=gps.GRID):
    """The table arrives in parts by event id, which orders the arrivals of all sources."""
    root = scratch_path(spark, "gps-stream")
    sinks = GpsSinks(root, LateFilter(f"{root}/seen", sources=[]))

    def job(events):
        return io.each_batch(normalized_stream(b.gps_messages(events), options, lookup), sinks.write, f"{root}/checkpoint")

    io.replay(b.table(spark, sf_dir, "events"), "event_id", BATCHES, f"{root}/in", job)
    return sinks


_LATE = gq._LATE_SQL


@query(f"""WITH {_LATE}
SELECT arrival, taxi_id, event_time, {b.grid_zone_sql()} AS zone_id, round(speed, 6) AS speed FROM judged WHERE NOT is_late""")
def stream_normalized(spark, sf_dir):
    sinks = _through_sinks(spark, sf_dir)
    return plain_times(sinks.processed(spark).select(
        "arrival", "taxi_id", "event_time", "zone_id", r6("speed")), "event_time")


@query(f"""WITH {_LATE}
SELECT arrival, taxi_id, event_time, CAST((before - 180001 - ms) // 1000 AS BIGINT) AS late_by_sec FROM judged WHERE is_late""")
def stream_late_events(spark, sf_dir):
    sinks = _through_sinks(spark, sf_dir)
    return plain_times(sinks.late(spark).select(
        "arrival", "taxi_id", "event_time", "late_by_sec"), "event_time")


@query(f"""WITH {_LATE}
SELECT DISTINCT 'Casablanca' AS city, {b.grid_zone_sql()} AS zone_id, event_time, taxi_id FROM judged WHERE NOT is_late""")
def stream_positions(spark, sf_dir):
    sinks = _through_sinks(spark, sf_dir)
    return plain_times(sinks.positions(spark).select(
        "city", "zone_id", "event_time", "taxi_id"), "event_time")


@query(f"""WITH {gq._PLACED_SQL}
SELECT z.zone_id, z.name AS arrondissement, i.arrival
FROM inbox i JOIN (SELECT * FROM containing UNION ALL SELECT * FROM nearest) c ON c.id = i.id
JOIN zones z ON z.seq = c.seq""")
def stream_polygon_zones(spark, sf_dir):
    """The stateless part with polygons, replayed straight into files."""
    root = scratch_path(spark, "polygon-stream")
    stream = normalized_stream(
        b.gps_messages(arriving(spark, sf_dir, "events")), gps.POLYGON, b.zone_lookup(spark, sf_dir))
    io.drain(io.to_files(stream, f"{root}/out", f"{root}/checkpoint"))
    return spark.read.parquet(f"{root}/out").select("zone_id", "arrondissement", "arrival")


def _sides_of(events):
    """Positions and requests as streams over the same events."""
    at = F.col("ts").cast("timestamp").alias("event_time")
    zone = gps.geo.grid_zone(b._lat(), b._lon()).alias("zone_id")
    positions = events.filter("event_type <> 'purchase'").select(zone, at, F.col("user_id").alias("taxi_id"))
    requests = events.filter("event_type = 'purchase'").select(zone, at, F.lit("requested").alias("status"))
    return positions, requests


def _closing(events, event_type="ping"):
    """A ping two days after the last event: whatever it belongs to stays open, all before it is over."""
    values = {"event_id": F.lit(-1), "user_id": F.lit(0), "ts": F.max("ts") + F.expr("INTERVAL 2 DAYS"),
              "event_type": F.lit(event_type)}
    return events.agg(*[values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in events.schema])


def _replayed_demand(spark, sf_dir, window):
    """The table arrives in spans of time, then a ping two days later, which closes all windows."""
    root = scratch_path(spark, "demand-stream")
    events = b.table(spark, sf_dir, "events", "event_id", "user_id", "ts", "event_type")
    def job(arriving):
        return io.to_files(jobs.demand_stream(*_sides_of(arriving), window=window), f"{root}/out", f"{root}/checkpoint")

    io.replay(events, "ts", BATCHES, f"{root}/in", job, _closing(events))
    return plain_times(
        spark.read.parquet(f"{root}/out").withColumn("ratio", F.round("ratio", 6)), "window_start", "window_end")


@query(dq._supply_sql("1 HOUR"))
def stream_demand(spark, sf_dir):
    return _replayed_demand(spark, sf_dir, "1 hour")


@query(dq._supply_sql("30 SECOND"))
def stream_demand_30s(spark, sf_dir):
    return _replayed_demand(spark, sf_dir, "30 seconds")


@query()
def stream_demand_approx(spark, sf_dir):
    root = scratch_path(spark, "approx-stream")
    events = arriving(spark, sf_dir, "events")
    asked = F.col("event_type") == "purchase"
    sides = events.select(
        gps.geo.grid_zone(b._lat(), b._lon()).alias("zone_id"), F.col("ts").cast("timestamp").alias("event_time"),
        F.when(~asked, F.col("user_id")).alias("taxi_id"), asked.cast("int").alias("pending"))
    io.drain(io.to_files(jobs.demand_approx(sides, "1 hour"), f"{root}/out", f"{root}/checkpoint"))
    return plain_times(spark.read.parquet(f"{root}/out"), "window_start", "window_end")


@query("SELECT event_id, ts AS event_time FROM events")
def stream_without_repeats(spark, sf_dir):
    """Every event is sent twice."""
    root = scratch_path(spark, "repeat-stream")
    events = arriving(spark, sf_dir, "events").select(
        "event_id", F.col("ts").cast("timestamp").alias("event_time"), F.explode(F.array(F.lit(1), F.lit(2))).alias("copy"))
    io.drain(io.to_files(jobs.without_repeats(events), f"{root}/out", f"{root}/checkpoint"))
    return plain_times(spark.read.parquet(f"{root}/out").select("event_id", "event_time"), "event_time")


@query("SELECT 'raw.gps' AS topic, CAST(CAST(ts AS DATE) AS VARCHAR) AS date, count(*) AS messages FROM events GROUP BY ALL")
def stream_archive(spark, sf_dir):
    root = scratch_path(spark, "archive")
    events = arriving(spark, sf_dir, "events")
    messages = events.select(
        F.lit(io.RAW_GPS_TOPIC).alias("topic"), F.col("ts").cast("timestamp").alias("received_at"),
        F.col("user_id").cast("string").alias("key"), F.to_json(F.struct("event_id", "user_id", "value")).alias("value"))
    io.drain(io.archive(messages, f"{root}/out", f"{root}/checkpoint"))
    return spark.read.parquet(f"{root}/out").groupBy("topic", F.col("date").cast("string").alias("date")).agg(
        F.count(F.lit(1)).alias("messages"))


_SESSIONS_SQL = f"""WITH {b.GPS_SQL},
dark AS (SELECT taxi_id, event_time, lag(event_time) OVER (PARTITION BY taxi_id ORDER BY event_time) AS previous
         FROM gps WHERE status = 'blackout'),
numbered AS (
  SELECT *, sum(CASE WHEN previous IS NULL OR event_time - previous > INTERVAL 180 MINUTE THEN 1 ELSE 0 END)
            OVER (PARTITION BY taxi_id ORDER BY event_time) AS session FROM dark),
sessions AS (
  SELECT taxi_id, min(event_time) AS started_at, max(event_time) AS last_seen_at, count(*) AS pings
  FROM numbered GROUP BY taxi_id, session)
SELECT *, CAST(floor(epoch(last_seen_at)) - floor(epoch(started_at)) AS BIGINT) AS seconds,
       floor(epoch(last_seen_at)) - floor(epoch(started_at)) > 120 AS alert FROM sessions"""


@query(_SESSIONS_SQL)
def blackout_sessions(spark, sf_dir):
    out = lifecycle.blackout_sessions(b.gps_events(b.table(spark, sf_dir, "events")), "180 minutes")
    return plain_times(out, "started_at", "last_seen_at")


@query(_SESSIONS_SQL)
def stream_blackouts(spark, sf_dir):
    root = scratch_path(spark, "blackout-stream")
    events = b.table(spark, sf_dir, "events")

    def job(arriving):
        # Every tenth event is half an hour late, so the watermark waits longer than that.
        return io.to_files(jobs.blackout_stream(b.gps_events(arriving), "180 minutes", "1 hour"),
                           f"{root}/out", f"{root}/checkpoint")

    # Spark filters before it sets the watermark, so the closing event has to be of the kind that is kept.
    io.replay(events, "ts", BATCHES, f"{root}/in", job, _closing(events, "error"))
    return plain_times(spark.read.parquet(f"{root}/out"), "started_at", "last_seen_at")


def _overdue_sql(key, name, limits):
    """Runs of equal states in the table ``states`` (key, moment, rank, state) that outlast their limit."""
    rows = ", ".join(f"('{state}', {seconds})" for state, seconds in limits.items())
    return f"""limits(state, seconds) AS (VALUES {rows}),
marked AS (
  SELECT *, lag(state) OVER (PARTITION BY key ORDER BY moment, rank) AS before FROM states),
runs AS (
  SELECT key, state, moment, lead(moment) OVER (PARTITION BY key ORDER BY moment, rank) AS ended FROM marked
  WHERE before IS DISTINCT FROM state)
SELECT CAST(key AS VARCHAR) AS {key}, state AS {name}, moment AS started_at, moment + to_seconds(seconds) AS overdue_at
FROM runs JOIN limits USING (state) WHERE ended IS NULL OR ended > moment + to_seconds(seconds)"""


@query(f"""WITH {b.GPS_SQL},
states AS (
  SELECT taxi_id AS key, event_time AS moment, event_id AS rank,
         CASE WHEN status = 'blackout' THEN 'dark' ELSE 'seen' END AS state FROM gps),
{_overdue_sql("taxi_id", "status", {"dark": 7200})}""".replace(" state AS status,", ""))
def stream_blackout_alerts(spark, sf_dir):
    """Vehicles that have been dark for two hours and still are; pings of a vehicle are hours apart in the table."""
    root = scratch_path(spark, "alert-stream")

    def job(arriving):
        # Every tenth event is half an hour late, so the watermark waits longer than that.
        alerts = timers.blackout_alerts(jobs.watermarked(b.gps_events(arriving), "1 hour"), alert_seconds=7200)
        return io.to_files(alerts, f"{root}/out", f"{root}/checkpoint")

    events = b.table(spark, sf_dir, "events")
    io.replay(events, "ts", BATCHES, f"{root}/in", job, _closing(events))
    return plain_times(spark.read.parquet(f"{root}/out"), "started_at", "overdue_at")


_STAGE_LIMITS = {"requested": 10 * 86400, "accepted": 20 * 86400, "in_progress": 30 * 86400}


@query(f"""WITH states AS (
  SELECT l_orderkey AS key, l_shipdate + to_minutes(l_linenumber) AS moment, l_linenumber % 4 AS rank,
         ['requested', 'accepted', 'in_progress', 'completed'][l_linenumber % 4 + 1] AS state FROM lineitem),
{_overdue_sql("trip_id", "status", _STAGE_LIMITS)}""")
def stream_stuck_trips(spark, sf_dir):
    """Trips that stay in a stage for longer than 10, 20 or 30 days; updates of a trip are days apart in the table."""
    root = scratch_path(spark, "stuck-stream")
    wanted = ("l_orderkey", "l_linenumber", "l_shipdate")
    lines = b.table(spark, sf_dir, "lineitem", *wanted)

    def job(arriving):
        updates = dq.updates_of(arriving).withColumnRenamed("timestamp_utc", "event_time")
        return io.to_files(timers.stuck_trips(jobs.watermarked(updates, "1 day"), _STAGE_LIMITS), f"{root}/out", f"{root}/checkpoint")

    later = {"l_orderkey": F.lit(-1), "l_linenumber": F.lit(3), "l_shipdate": F.max("l_shipdate") + F.expr("INTERVAL 40 DAYS")}
    closing = lines.agg(*[later[f.name].cast(f.dataType).alias(f.name) for f in lines.schema])
    io.replay(lines, "l_shipdate", BATCHES, f"{root}/in", job, closing)
    return plain_times(spark.read.parquet(f"{root}/out"), "started_at", "overdue_at")


_IDLE_SQL = """arrived AS (
  SELECT event_id AS arrival, CASE WHEN event_id % 1000 < 600 AND event_id % 3 = 0 THEN 1 ELSE 0 END AS source,
         event_id * 10000 AS received, epoch_us(CASE WHEN event_id % 1000 < 600 AND event_id % 3 = 0 THEN ts - INTERVAL 20 MINUTE
           WHEN event_id % 10 = 0 THEN ts - INTERVAL 30 MINUTE ELSE ts END) // 1000 AS ms FROM events),
known AS (
  SELECT e.arrival, e.received, max(CASE WHEN e.source = s.source THEN ms END) OVER w AS newest,
         max(CASE WHEN e.source = s.source THEN received END) OVER w AS heard
  FROM arrived e CROSS JOIN (SELECT DISTINCT source FROM arrived) s
  WINDOW w AS (PARTITION BY s.source ORDER BY arrival ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
least AS (SELECT arrival, min(newest) FILTER (received - heard <= 30000) AS m FROM known GROUP BY arrival),
marks AS (SELECT arrival, max(m) OVER (ORDER BY arrival) AS m FROM least)"""


@query(f"""WITH {_IDLE_SQL}
SELECT arrival, source, m AS max_before_ms, coalesce(ms < m - 180001, FALSE) AS is_late,
       CASE WHEN ms < m - 180001 THEN CAST((m - 180001 - ms) // 1000 AS BIGINT) END AS late_by_sec
FROM arrived JOIN marks USING (arrival)""")
def stream_idle_source(spark, sf_dir):
    """Two sources, one of them slow and at times silent, under one watermark."""
    root = scratch_path(spark, "sources-stream")
    marks = SourceWatermark(f"{root}/state")

    def prepared(events):
        slow = (F.col("event_id") % 1000 < 600) & (F.col("event_id") % 3 == 0)
        back = F.when(slow, 20).when(F.col("event_id") % 10 == 0, 30).otherwise(0)
        return events.select(
            F.col("event_id").alias("arrival"), slow.cast("int").alias("source"),
            F.timestamp_seconds(F.col("event_id") * 10).alias("received_at"),
            (F.col("ts").cast("timestamp") - F.make_interval(mins=back)).alias("event_time"))

    def write(batch, batch_id):
        marks.apply(batch, batch_id).write.mode("overwrite").parquet(f"{root}/out/batch_id={batch_id}")

    io.replay(b.table(spark, sf_dir, "events", "event_id", "ts"), "event_id", BATCHES, f"{root}/in",
              lambda arriving: io.each_batch(prepared(arriving), write, f"{root}/checkpoint"))
    return spark.read.parquet(f"{root}/out").select("arrival", "source", "max_before_ms", "is_late", "late_by_sec")


def _lifecycle_sql():
    from fleetlens.plans.registry import ORACLE
    return ORACLE["trip_lifecycle"].split("\nSELECT *,")[0] + " SELECT * FROM firsts"


@query(_lifecycle_sql())
def stream_lifecycle(spark, sf_dir):
    root = scratch_path(spark, "lifecycle-stream")
    updates = dq.updates_of(arriving(spark, sf_dir, "lineitem"))
    log = jobs.LifecycleLog(f"{root}/trips")
    io.drain(io.each_batch(updates, log.write, f"{root}/checkpoint"))
    trips = log.trips(spark).withColumnRenamed("timestamp_utc", "updated_at")
    return plain_times(trips, "updated_at", *[f"{s}_at" for s in lifecycle.STAGES])


def _match_sql():
    from fleetlens.plans.registry import ORACLE
    return ORACLE["match_nearest"]


@query(_match_sql())
def stream_match(spark, sf_dir):
    root = scratch_path(spark, "match-stream")
    wanted = ("event_id", "user_id", "ts", "event_type")

    def prepared(events):
        return events.select(
            "event_id", F.col("user_id").alias("taxi_id"), F.col("ts").cast("timestamp").alias("event_time"),
            b._lat().alias("lat"), b._lon().alias("lon"), gps.geo.grid_zone(b._lat(), b._lon()).alias("zone_id"),
            F.when(F.col("event_type") == "error", "blackout").otherwise("moving").alias("status"),
            (F.col("event_type") == "purchase").alias("is_request"))

    matcher = jobs.Matcher(f"{root}/log", f"{root}/matches", f"{root}/open")

    def job(arriving):
        return io.each_batch(prepared(arriving), matcher.write, f"{root}/checkpoint")

    io.replay(b.table(spark, sf_dir, "events", *wanted), "ts", BATCHES, f"{root}/in", job)
    matcher.close(spark, BATCHES - 1)
    return matcher.results(spark).select(
        "request_id", "taxi_id", "taxi_zone", "ring", r6("distance_km"), r6("eta_min"))
