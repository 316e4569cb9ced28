"""Demand windows, features, forecasts, matching, trip states."""

from __future__ import annotations

from pyspark.sql import functions as F

from fleetlens import constants as K
from fleetlens.operators import demand, features, forecast, lifecycle, match
from fleetlens.plans import bindings as b
from fleetlens.plans.registry import plain_times, query, r6
from fleetlens.session import scratch_path


# --- demand and supply ---------------------------------------------------------------------------

def _supply_sql(window: str) -> str:
    return f"""WITH {b.MATCH_SQL},
both_sides AS (
  SELECT zone_id, time_bucket(INTERVAL {window}, event_time) AS window_start, taxi_id, 0 AS pending FROM positions
  UNION ALL
  SELECT zone_id, time_bucket(INTERVAL {window}, event_time), NULL, 1 FROM requests),
totals AS (
  SELECT zone_id, window_start, window_start + INTERVAL {window} AS window_end,
         count(DISTINCT taxi_id) AS active_vehicles, CAST(sum(pending) AS BIGINT) AS pending_requests
  FROM both_sides GROUP BY ALL)
SELECT *, CASE WHEN active_vehicles > 0 THEN round(pending_requests / active_vehicles, 6) END AS ratio FROM totals"""


def _supply(spark, sf_dir, window):
    out = demand.demand_supply(b.positions(spark, sf_dir), b.requests(spark, sf_dir), window)
    return plain_times(out.withColumn("ratio", F.round("ratio", 6)), "window_start", "window_end")


@query(_supply_sql("30 SECOND"))
def demand_supply_30s(spark, sf_dir):
    return _supply(spark, sf_dir, K.DEMAND_WINDOW)


@query(_supply_sql("1 HOUR"))
def demand_supply_1h(spark, sf_dir):
    return _supply(spark, sf_dir, "1 hour")


@query(f"""WITH {b.MATCH_SQL},
counts AS (SELECT zone_id, CAST(floor(epoch(event_time)) AS BIGINT) // 3600 AS slot, count(*) AS requests
           FROM requests GROUP BY ALL),
starts AS (SELECT zone_id, min(slot) AS first_slot FROM counts GROUP BY 1),
rated AS (
  SELECT c.zone_id, c.slot, c.requests,
         (SELECT sum(p.requests) FROM counts p WHERE p.zone_id = c.zone_id AND p.slot BETWEEN c.slot - 24 AND c.slot - 1)
         / nullif(least(24, c.slot - first_slot), 0) AS usual
  FROM counts c JOIN starts s ON s.zone_id = c.zone_id)
SELECT zone_id, CAST(make_timestamp(slot * 3600 * 1000000) AS TIMESTAMP) AS window_start, requests, round(usual, 6) AS usual
FROM rated WHERE usual > 0 AND requests >= 3 * usual AND requests >= 2""")
def demand_spikes(spark, sf_dir):
    out = demand.demand_spikes(b.requests(spark, sf_dir), window_seconds=3600)
    return plain_times(out.withColumn("usual", F.round("usual", 6)), "window_start")


# --- features and forecast -------------------------------------------------------------------------

def slots(spark, sf_dir):
    return demand.demand_slots(b.demand_trips(spark, sf_dir))


def order_slots(spark, sf_dir):
    return demand.demand_slots(b.order_demand_trips(spark, sf_dir))


_SLOT_TEXT = "strftime(make_timestamp(slot * 1800 * 1000000), '%Y-%m-%d %H:%M:%S')"


@query(f"WITH {b.DEMAND_SQL} SELECT zone_id, slot, {_SLOT_TEXT} AS slot_30min, demand FROM demand")
def demand_slots(spark, sf_dir):
    return slots(spark, sf_dir).select("zone_id", "slot", "slot_30min", "demand")


_FILLED_SQL = """,
spans AS (SELECT zone_id, min(slot) AS lo, max(slot) AS hi FROM demand GROUP BY 1),
filled AS (
  SELECT g.zone_id, g.slot, coalesce(d.demand, 0) AS demand
  FROM (SELECT zone_id, unnest(range(lo, hi + 1)) AS slot FROM spans) g
  LEFT JOIN demand d ON d.zone_id = g.zone_id AND d.slot = g.slot)"""


def _features_sql(series: str) -> str:
    return f""",
lagged AS (
  SELECT *, lag(demand, 48) OVER w AS lag1, lag(demand, 336) OVER w AS lag7,
         avg(demand) OVER (PARTITION BY zone_id ORDER BY slot ROWS BETWEEN 336 PRECEDING AND 1 PRECEDING) AS roll,
         make_timestamp(slot * 1800 * 1000000) AS moment
  FROM {series} WINDOW w AS (PARTITION BY zone_id ORDER BY slot)),
features AS (
  SELECT zone_id, {_SLOT_TEXT} AS slot_30min, demand AS target, moment AS "timestamp", CAST(hour(moment) AS INTEGER) AS hour,
         CAST(dayofweek(moment) + 1 AS INTEGER) AS day_of_week, CASE WHEN dayofweek(moment) IN (0, 6) THEN 1 ELSE 0 END AS is_weekend,
         CASE WHEN dayofweek(moment) = 5 THEN 1 ELSE 0 END AS is_friday, CAST(CAST(moment AS DATE) AS VARCHAR) AS date,
         lag1 AS demand_lag_1d, lag7 AS demand_lag_7d, round(roll, 6) AS rolling_7d_mean
  FROM lagged WHERE lag1 IS NOT NULL AND lag7 IS NOT NULL AND roll IS NOT NULL)"""


def _shown(df):
    shown = df.withColumns({
        "rolling_7d_mean": F.round("rolling_7d_mean", 6), "date": F.col("date").cast("string")})
    return plain_times(shown, "timestamp")


@query(f"WITH {b.DEMAND_SQL} {_features_sql('demand')} SELECT * FROM features")
def features_rowlag(spark, sf_dir):
    return _shown(features.features_rowlag(slots(spark, sf_dir)))


@query(f"WITH {b.DEMAND_SQL} {_FILLED_SQL} {_features_sql('filled')} SELECT * FROM features")
def features_timelag(spark, sf_dir):
    return _shown(features.features_timelag(slots(spark, sf_dir)))


_SPLIT_SQL = f"""WITH {b.ORDER_DEMAND_SQL} {_features_sql('demand')},
split AS (
  SELECT *, strftime("timestamp", '%Y-%m') AS month,
         dense_rank() OVER (ORDER BY strftime("timestamp", '%Y-%m')) AS month_rank FROM features)"""


def split(spark, sf_dir):
    return features.split_by_month(features.features_rowlag(order_slots(spark, sf_dir)))


@query(f"{_SPLIT_SQL} SELECT month, month_rank <= 10 AS is_train, count(*) AS n FROM split GROUP BY ALL")
def split_by_month(spark, sf_dir):
    return split(spark, sf_dir).groupBy("month", "is_train").agg(F.count(F.lit(1)).alias("n"))


@query(f"{_SPLIT_SQL} SELECT round(sqrt(avg((target - demand_lag_7d) * (target - demand_lag_7d))), 6) AS rmse "
       "FROM split WHERE month_rank > 10")
def naive_rmse(spark, sf_dir):
    return forecast.naive_score(split(spark, sf_dir)).select(r6("rmse"))


@query()
def gbt_evaluation(spark, sf_dir):
    """Train, save, load, and compare with the naive forecast."""
    rows = split(spark, sf_dir)
    path = scratch_path(spark, "model")
    forecast.save_model(forecast.train(rows), path)
    return forecast.evaluate(forecast.load_model(path), rows)


@query()
def gbt_importances(spark, sf_dir):
    """The three features that matter most."""
    return forecast.importances(forecast.train(split(spark, sf_dir)), spark).limit(3)


def _asked(spark, sf_dir):
    """Forecast requests: the purchases, asked for the moment they were made."""
    e = b.table(spark, sf_dir, "events", "event_id", "user_id", "ts", "event_type")
    return e.filter(F.col("event_type") == "purchase").select(
        F.col("event_id").alias("request_id"), (F.col("user_id") % 16 + 1).cast("int").alias("zone_id"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("datetime"))


@query(f"""WITH {b.DEMAND_SQL}, {b.GPS_SQL.replace("FROM events)", "FROM events WHERE event_type = 'purchase')")},
asked AS (
  SELECT event_id AS request_id, CAST(user_id % 16 + 1 AS INTEGER) AS zone_id, ts,
         CAST(floor(epoch(ts)) AS BIGINT) // 1800 AS slot FROM events WHERE event_type = 'purchase'),
firsts AS (SELECT zone_id, min(slot) AS first_slot FROM demand GROUP BY 1),
rolled AS (
  SELECT a.request_id, sum(d.demand) / 336 AS roll FROM asked a
  JOIN demand d ON d.zone_id = a.zone_id AND d.slot BETWEEN a.slot - 336 AND a.slot - 1 GROUP BY 1)
SELECT a.request_id, a.zone_id, CAST(hour(a.ts) AS INTEGER) AS hour, CAST(dayofweek(a.ts) + 1 AS INTEGER) AS day_of_week,
       CASE WHEN reach THEN coalesce(d1.demand, 0) END AS demand_lag_1d,
       CASE WHEN reach THEN coalesce(d7.demand, 0) END AS demand_lag_7d,
       CASE WHEN reach THEN round(coalesce(roll, 0), 6) END AS rolling_7d_mean
FROM (SELECT a.*, slot - 336 >= first_slot AS reach FROM asked a JOIN firsts f ON f.zone_id = a.zone_id) a
LEFT JOIN demand d1 ON d1.zone_id = a.zone_id AND d1.slot = a.slot - 48
LEFT JOIN demand d7 ON d7.zone_id = a.zone_id AND d7.slot = a.slot - 336
LEFT JOIN rolled r ON r.request_id = a.request_id""")
def forecast_features(spark, sf_dir):
    rows = features.request_features(_asked(spark, sf_dir), slots(spark, sf_dir))
    return rows.select(
        "request_id", "zone_id", "hour", "day_of_week", "demand_lag_1d", "demand_lag_7d",
        F.round("rolling_7d_mean", 6).alias("rolling_7d_mean"))


@query()
def forecast_score(spark, sf_dir):
    """Predicted demand per request, with the model of ``gbt_evaluation``, which knows none of these slots.

    A request whose zone has no week of history before it has no prediction, and says so.
    """
    model = forecast.train(split(spark, sf_dir))
    asked = features.request_features(_asked(spark, sf_dir), slots(spark, sf_dir))
    return forecast.predict(model, asked).select(
        "request_id", "zone_id", "datetime", F.col("prediction").alias("predicted_demand"),
        F.when(F.col("prediction").isNull(), "short history").alias("reason"))


@query(f"""WITH {b.ORDER_DEMAND_SQL} {_features_sql('demand')}, {b.ZONES_SQL},
extra AS (SELECT zone_id, arg_min(population, seq) AS population, arg_min(centroid_lat, seq) AS lat,
          arg_min(centroid_lon, seq) AS lon FROM zones GROUP BY 1)
SELECT f.zone_id, f.slot_30min, f.target, CAST(e.population AS DOUBLE) AS zone_population,
       round(e.lat, 6) AS centroid_lat, round(e.lon, 6) AS centroid_lon
FROM features f LEFT JOIN extra e ON e.zone_id = f.zone_id""")
def zone_features(spark, sf_dir):
    rows = features.zone_metadata(
        features.features_rowlag(order_slots(spark, sf_dir)), b.zones(spark, sf_dir))
    return rows.select(
        "zone_id", "slot_30min", "target", "zone_population", r6("centroid_lat"), r6("centroid_lon"))


# --- trip states -------------------------------------------------------------------------------------

def status_updates(spark, sf_dir):
    """Updates of trips from ``lineitem``: each line moves its order to the stage of its number."""
    return updates_of(b.table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_shipdate"))


def updates_of(li):
    stage = F.element_at(F.array(*[F.lit(s) for s in lifecycle.STAGES]), (F.col("l_linenumber") % 4 + 1).cast("int"))
    at = F.unix_timestamp(F.col("l_shipdate").cast("timestamp")) + F.col("l_linenumber") * 60
    return li.select(
        F.col("l_orderkey").alias("trip_id"), stage.alias("status"), F.timestamp_seconds(at).alias("timestamp_utc"))


@query("""WITH updates AS (
  SELECT l_orderkey AS trip_id, l_linenumber % 4 AS stage,
         ['requested', 'accepted', 'in_progress', 'completed'][l_linenumber % 4 + 1] AS status,
         l_shipdate + to_minutes(l_linenumber) AS moment FROM lineitem),
firsts AS (
  SELECT trip_id, arg_max(status, (moment, stage)) AS status, max(moment) AS updated_at,
         min(moment) FILTER (status = 'requested') AS requested_at, min(moment) FILTER (status = 'accepted') AS accepted_at,
         min(moment) FILTER (status = 'in_progress') AS in_progress_at, min(moment) FILTER (status = 'completed') AS completed_at
  FROM updates GROUP BY 1)
SELECT *, CAST(epoch(accepted_at) - epoch(requested_at) AS BIGINT) AS wait_sec,
       CAST(epoch(in_progress_at) - epoch(accepted_at) AS BIGINT) AS pickup_sec,
       CAST(epoch(completed_at) - epoch(in_progress_at) AS BIGINT) AS ride_sec FROM firsts""")
def trip_lifecycle(spark, sf_dir):
    out = lifecycle.trip_lifecycle(status_updates(spark, sf_dir))
    return plain_times(out, "updated_at", *[f"{s}_at" for s in lifecycle.STAGES])


@query(f"""WITH {b.GPS_SQL},
seen AS (
  SELECT *, max(CASE WHEN status <> 'blackout' THEN (event_time, event_id) END) OVER w AS ok_before,
         min(CASE WHEN status <> 'blackout' THEN (event_time, event_id) END) OVER
           (PARTITION BY taxi_id ORDER BY event_time, event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS ok_after
  FROM gps WINDOW w AS (PARTITION BY taxi_id ORDER BY event_time, event_id)),
islands AS (
  SELECT taxi_id, min(event_time) AS started_at, max(event_time) AS last_seen_at, ok_after[1] AS recovered_at, count(*) AS pings
  FROM seen WHERE status = 'blackout' GROUP BY taxi_id, ok_before, ok_after)
SELECT *, CAST(floor(epoch(coalesce(recovered_at, last_seen_at))) - floor(epoch(started_at)) AS BIGINT) AS seconds,
       floor(epoch(coalesce(recovered_at, last_seen_at))) - floor(epoch(started_at)) > 120 AS alert
FROM islands""")
def blackouts(spark, sf_dir):
    out = lifecycle.blackouts(b.gps_events(b.table(spark, sf_dir, "events")))
    return plain_times(out, "started_at", "last_seen_at", "recovered_at")


# --- matching ------------------------------------------------------------------------------------------

_NEAREST_SQL = f"""WITH {b.MATCH_SQL},
periods AS (
  SELECT *, lead(event_time) OVER (PARTITION BY taxi_id ORDER BY event_time, event_id) AS next_time FROM positions),
pairs AS (
  SELECT r.request_id, r.event_time, p.taxi_id, p.zone_id AS taxi_zone, CASE WHEN p.zone_id = r.zone_id THEN 0 ELSE 1 END AS ring,
         {b.haversine_sql("r.lat", "r.lon", "p.lat", "p.lon")} AS km
  FROM requests r JOIN periods p
    ON p.event_time <= r.event_time AND p.event_time >= r.event_time - INTERVAL 180 SECOND
   AND (p.next_time IS NULL OR r.event_time < p.next_time)
   AND abs((p.zone_id - 1) % 4 - (r.zone_id - 1) % 4) <= 1 AND abs((p.zone_id - 1) // 4 - (r.zone_id - 1) // 4) <= 1
  WHERE p.status <> 'blackout')"""


@query(f"""{_NEAREST_SQL},
best AS (
  SELECT request_id, taxi_id, taxi_zone, ring, round(km, 6) AS distance_km,
         round(CASE WHEN km > 0 THEN greatest(2::DOUBLE, km / 25 * 60) ELSE 5::DOUBLE END, 6) AS eta_min
  FROM pairs QUALIFY row_number() OVER (PARTITION BY request_id ORDER BY ring, km, taxi_id) = 1)
SELECT r.request_id, taxi_id, taxi_zone, ring, distance_km, eta_min FROM requests r LEFT JOIN best b ON b.request_id = r.request_id""")
def match_nearest(spark, sf_dir):
    out = match.match_nearest(b.requests(spark, sf_dir), b.positions(spark, sf_dir))
    return out.select("request_id", "taxi_id", "taxi_zone", "ring", r6("distance_km"), r6("eta_min"))


@query()
def match_exclusive(spark, sf_dir):
    out = match.match_exclusive(b.requests(spark, sf_dir), b.positions(spark, sf_dir), window_seconds=600)
    return out.select("request_id", "taxi_id", "taxi_zone", "ring", "round", r6("distance_km"), r6("eta_min"))
