"""Nearest available vehicle per request.

A ping is valid from its time until the next ping of the same taxi, at most ``fresh`` seconds. A request
may take any taxi with a ping valid at its time: first one in its own zone, else in a neighbouring zone,
always the nearest, ties to the lowest taxi id.

Candidates are met through equi-joins on (place, time bucket), narrow places first. Only requests that
found nothing close by go on to the wider search, so dense places are never searched as a whole.
"""

from __future__ import annotations

import itertools
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetlens import constants as K
from fleetlens.functions import geo, trips as tf
from fleetlens.operators.ordered import drop_halo, with_halo
from fleetlens.session import materialize

FRESH_SECONDS = K.LATENESS_MS // 1000
NEAR_CELLS_DEG = (0.001, 0.01)  # about 100 m and 1 km
_MICROS = 1_000_000


def valid_periods(positions: DataFrame, fresh: int = FRESH_SECONDS) -> DataFrame:
    """Pings with ``from_us`` and ``until_us``, the microseconds at which they start and stop to count.

    ``positions``: taxi_id, event_id, event_time, lat, lon, zone_id, status. ``until_us`` is exclusive.
    Blackout pings end the period before them but open none.
    """
    stamped = positions.withColumn("from_us", F.unix_micros("event_time"))
    span = fresh * _MICROS
    near = with_halo(stamped, F.col("from_us"), max(10 * span, _MICROS), after=span)
    order = Window.partitionBy("taxi_id", "__block").orderBy("from_us", "event_id")
    limit = F.col("from_us") + span + 1
    until = F.least(F.lead("from_us").over(order), limit)
    rows = drop_halo(near.withColumn("until_us", F.coalesce(until, limit)))
    return rows.filter((F.col("until_us") > F.col("from_us")) & (F.col("status") != "blackout")).select(
        "taxi_id", "lat", "lon", "zone_id", "from_us", "until_us")


def bulk(side: DataFrame) -> DataFrame:
    """A side of a join that grows with the input. Below the broadcast limit it would go through the driver, one such table
    for each search of each round or batch, which adds up."""
    return side.hint("merge")


def _by_bucket(periods: DataFrame, fresh: int) -> DataFrame:
    """One row per time bucket a period touches: one or two, since a bucket is as long as a period can be."""
    width = fresh * _MICROS
    buckets = F.sequence(F.floor(F.col("from_us") / width), F.floor((F.col("until_us") - 1) / width))
    return periods.withColumn("bucket", F.explode(buckets))


def _best(pairs: DataFrame, ring: int) -> DataFrame:
    """Nearest candidate per request; the minimum is merged before the shuffle."""
    distance = geo.haversine_km(F.col("req_lat"), F.col("req_lon"), F.col("lat"), F.col("lon"))
    choice = F.struct(distance.alias("distance_km"), "taxi_id", F.col("zone_id").alias("taxi_zone"))
    return pairs.groupBy("request_id").agg(F.min(choice).alias("best")).select(
        "request_id", F.lit(ring).alias("ring"), "best.*")


def _surely_within(size: float) -> Column:
    """Distance below which no taxi outside the 3x3 cells can be closer."""
    step = F.radians(F.lit(size))
    across = F.asin(F.cos(F.radians("req_lat")) * F.sin(step))
    return F.least(across, step) * (K.EARTH_RADIUS_KM * (1 - 1e-9))


def _requests(requests: DataFrame, fresh: int, *extra: str) -> DataFrame:
    at = F.unix_micros("event_time")
    return requests.select(
        "request_id", F.col("lat").alias("req_lat"), F.col("lon").alias("req_lon"),
        F.col("zone_id").alias("req_zone"), at.alias("at_us"),
        F.floor(at / (fresh * _MICROS)).alias("bucket"), *extra)


def match_nearest(requests: DataFrame, positions: DataFrame, fresh: int = FRESH_SECONDS) -> DataFrame:
    """Per request: taxi_id, taxi_zone, ring (0 own zone, 1 neighbour), distance, ETA; null without a candidate.

    ``requests``: request_id, event_time, lat, lon, zone_id.
    """
    periods = materialize(_by_bucket(valid_periods(positions, fresh), fresh), "periods")
    asked = materialize(_requests(requests, fresh), "requests")
    found = _nearest(asked, periods).withColumn("eta_min", tf.estimated_minutes(F.col("distance_km")))
    return asked.select("request_id").join(bulk(found), "request_id", "left")


def _nearest(asked: DataFrame, periods: DataFrame, taken: DataFrame | None = None) -> DataFrame:
    """Best taxi per request: certain matches close by, in growing cells, then the own zone, then the
    neighbours. Each search only sees the requests the one before left open.

    ``taken`` lists (dispatch, taxi_id) that may not be used.
    """
    def usable(pairs: DataFrame) -> DataFrame:
        alive = pairs.filter((F.col("at_us") >= F.col("from_us")) & (F.col("at_us") < F.col("until_us")))
        return alive if taken is None else alive.join(bulk(taken), ["dispatch", "taxi_id"], "left_anti")

    found, open_requests = [], asked
    for size in NEAR_CELLS_DEG:
        close = materialize(_close_by(open_requests, periods, usable, size), "close")
        found.append(close)
        open_requests = open_requests.join(bulk(close), "request_id", "left_anti")
    own = open_requests.withColumn("zone_id", F.col("req_zone")).join(bulk(periods), ["zone_id", "bucket"])
    in_zone = materialize(_best(usable(own), 0), "in-zone")
    found.append(in_zone)
    open_requests = open_requests.join(bulk(in_zone), "request_id", "left_anti")
    around = open_requests.withColumn("zone_id", F.explode(geo.zone_neighbours(F.col("req_zone"))))
    beside = _best(usable(around.join(bulk(periods), ["zone_id", "bucket"])), 1)
    return reduce(DataFrame.unionByName, found, beside)


def _close_by(asked: DataFrame, periods: DataFrame, usable, size: float) -> DataFrame:
    """Own-zone matches that are certain from the 3x3 cells around the request."""
    cells = periods.withColumns({
        "cell_lat": geo.cell(F.col("lat"), size), "cell_lon": geo.cell(F.col("lon"), size)})

    def around(c: str) -> Column:
        home = geo.cell(F.col(c), size)
        return F.explode(F.sequence(home - 1, home + 1))

    spread = asked.withColumn("cell_lat", around("req_lat")).withColumn("cell_lon", around("req_lon"))
    # The own zone is part of the join key, so other zones never form pairs.
    pairs = spread.withColumn("zone_id", F.col("req_zone")).join(
        bulk(cells), ["zone_id", "bucket", "cell_lat", "cell_lon"])
    near = _best(usable(pairs), 0).join(bulk(asked.select("request_id", "req_lat")), "request_id")
    return near.filter(F.col("distance_km") <= _surely_within(size)).drop("req_lat")


def match_exclusive(
    requests: DataFrame, positions: DataFrame, window_seconds: int = 30, fresh: int = FRESH_SECONDS,
) -> DataFrame:
    """Matches in which a taxi serves at most one request per dispatch window.

    Every round each open request proposes its best free taxi and each taxi keeps its nearest request,
    ties to the lowest request id. It ends when no open request has a free taxi. A round settles every taxi
    that was proposed, so the rounds are as many as the taxis that compete for one place and window at most.
    """
    periods = materialize(_by_bucket(valid_periods(positions, fresh), fresh), "periods")
    dispatch = F.floor(F.unix_timestamp("event_time") / window_seconds)
    open_requests = materialize(
        _requests(requests.withColumn("dispatch", dispatch), fresh, "dispatch"), "open")
    kept: DataFrame | None = None
    for number in itertools.count(1):
        taken = None if kept is None else kept.select("dispatch", "taxi_id")
        offers = materialize(_nearest(open_requests, periods, taken).join(
            bulk(open_requests.select("request_id", "dispatch")), "request_id"), "offers")
        if kept is not None and offers.isEmpty():
            return kept.withColumn("eta_min", tf.estimated_minutes(F.col("distance_km")))
        winners = offers.groupBy("dispatch", "taxi_id").agg(
            F.min(F.struct("distance_km", "request_id", "ring", "taxi_zone")).alias("w")).select(
            "w.request_id", "dispatch", "taxi_id", "w.taxi_zone", "w.ring", "w.distance_km",
            F.lit(number).alias("round"))
        kept = materialize(winners if kept is None else kept.unionByName(winners), "kept")
        # A request without an offer can get none later: taxis are only ever taken away.
        offered = open_requests.join(bulk(offers.select("request_id")), "request_id", "left_semi")
        open_requests = materialize(
            offered.join(bulk(kept.select("request_id")), "request_id", "left_anti"), "open")
