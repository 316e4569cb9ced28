import json

import pytest
from pyspark.sql import functions as F

from conftest import rows
from fleetlens.operators import demand, gps, lateness, lifecycle, match
from fleetlens.streaming import io, jobs
from fleetlens.streaming.normalizer import GpsSinks, LateFilter, normalized_stream
from test_match import city, frames

T0 = 1_704_103_200  # 2024-01-01 10:00:00 UTC
# Seconds before the newest event, and whether the event is kept.
CASES = [("n0", 0, True), ("m2", 120, True), ("edge3", 180, True), ("m4", 240, False), ("m10", 600, False)]


def gps_message(name, second, **fields):
    stamp = f"2024-01-01T10:{second // 60 + 30:02d}:{second % 60:02d}Z" if second >= 0 else None
    return json.dumps({"event_id": name, "taxi_id": name, "timestamp_utc": stamp, "lat": 33.55, "lon": -7.6, **fields})


def late_messages():
    return [(i, gps_message(name, 600 - back)) for i, (name, back, _) in enumerate(CASES)]


def as_batches(spark, folder, frames_):
    """Each frame becomes one file, that is one micro-batch."""
    for i, df in enumerate(frames_):
        df.coalesce(1).write.mode("append").parquet(str(folder))
    return io.read_files(spark, str(folder), frames_[0].schema, maxFilesPerTrigger="1")


def test_late_rule_in_batch(spark):
    raw = spark.createDataFrame(late_messages(), "arrival long, value string")
    flagged = lateness.flag_late(gps.normalize(gps.parse_gps(raw), gps.GRID)).collect()
    assert {r.event_id: not r.is_late for r in flagged} == {n: kept for n, _, kept in CASES}
    assert {r.event_id: r.late_by_sec for r in flagged if r.is_late} == {"m4": 59, "m10": 419}


@pytest.mark.parametrize("sources", [[], ["source"]])
def test_late_rule_across_micro_batches(spark, tmp_path, sources):
    parts = [spark.createDataFrame([(0, i, v)], "source int, arrival long, value string") for i, v in late_messages()]
    stream = normalized_stream(as_batches(spark, tmp_path / "in", parts), gps.GRID)
    sinks = GpsSinks(str(tmp_path / "out"), LateFilter(str(tmp_path / "seen"), sources))
    io.drain(io.each_batch(stream, sinks.write, str(tmp_path / "cp")))
    assert rows(sinks.processed(spark), "event_id") == sorted((n,) for n, _, kept in CASES if kept)
    assert rows(sinks.late(spark), "event_id", "late_by_sec") == [("m10", 419), ("m4", 59)]
    assert sinks.positions(spark).count() == 3


def test_a_repeated_batch_changes_nothing(spark, tmp_path):
    sinks = GpsSinks(str(tmp_path / "out"), LateFilter(str(tmp_path / "seen"), []))
    for batch_id, (i, v) in enumerate(late_messages()):
        df = normalized_stream(spark.createDataFrame([(i, v)], "arrival long, value string"), gps.GRID)
        sinks.write(df, batch_id)
        sinks.write(df, batch_id)
    assert sinks.positions(spark).count() == 3 and sinks.late(spark).count() == 2
    with pytest.raises(RuntimeError):
        sinks.late_filter.apply(df, 99)


def test_replay_equals_the_batch_form(spark, tmp_path):
    raw = spark.createDataFrame(late_messages() + [(9, '"x"')], "arrival long, value string")
    stream = normalized_stream(as_batches(spark, tmp_path / "in", [raw]), gps.GRID)
    io.drain(io.to_files(stream, str(tmp_path / "out"), str(tmp_path / "cp")))
    batch = gps.normalize(gps.parse_gps(raw), gps.GRID)
    assert rows(spark.read.parquet(str(tmp_path / "out")), *batch.columns) == rows(batch)


def sides(df):
    positions = df.filter("taxi_id is not null").select("zone_id", "event_time", "taxi_id")
    requests = df.filter("taxi_id is null").select("zone_id", "event_time", F.lit("requested").alias("status"))
    return positions, requests


def test_demand_stream_equals_batch(spark, tmp_path):
    data = [(z, T0 + s, (s + z) % 5 if s % 3 else None) for z in (1, 2) for s in range(0, 300, 7)]
    df = spark.createDataFrame(data, "zone_id int, s long, taxi_id long").select(
        "zone_id", F.timestamp_seconds("s").alias("event_time"), "taxi_id")
    # One side alone closes the windows: a silent one holds nothing back.
    closing = spark.createDataFrame([(3, T0 + 3600, 1)], "zone_id int, s long, taxi_id long").select(
        "zone_id", F.timestamp_seconds("s").alias("event_time"), "taxi_id")
    stream = as_batches(spark, tmp_path / "in", [df, closing])
    io.drain(io.to_files(jobs.demand_stream(*sides(stream)), str(tmp_path / "out"), str(tmp_path / "cp")))
    assert rows(spark.read.parquet(str(tmp_path / "out"))) == rows(demand.demand_supply(*sides(df)))


def test_pings_alone_close_the_windows(spark, tmp_path):
    df = spark.createDataFrame([(1, T0 + s, 1) for s in range(0, 3600, 10)], "zone_id int, s long, taxi_id long").select(
        "zone_id", F.timestamp_seconds("s").alias("event_time"), "taxi_id")

    def job(events):
        return io.to_files(jobs.demand_stream(*sides(events)), str(tmp_path / "out"), str(tmp_path / "cp"))

    io.replay(df, "event_time", 4, str(tmp_path / "in"), job)
    closed = spark.read.parquet(str(tmp_path / "out"))
    # All windows that end 3 minutes before the last ping or earlier, each once.
    assert closed.count() == closed.select("window_start").distinct().count() == (3590 - 180) // 30


def test_repeats_within_the_watermark_are_dropped(spark, tmp_path):
    df = spark.createDataFrame([("a", T0), ("a", T0), ("b", T0)], "event_id string, s long").select(
        "event_id", F.timestamp_seconds("s").alias("event_time"))
    stream = as_batches(spark, tmp_path / "in", [df, df])
    io.drain(io.to_files(jobs.without_repeats(stream), str(tmp_path / "out"), str(tmp_path / "cp")))
    assert rows(spark.read.parquet(str(tmp_path / "out")), "event_id") == [("a",), ("b",)]


def test_lifecycle_over_several_batches(spark, tmp_path):
    def updates(*items):
        return spark.createDataFrame(items, "trip_id string, status string, s long").select(
            "trip_id", "status", F.timestamp_seconds("s").alias("timestamp_utc"))
    parts = [updates(("t", "requested", T0), ("u", "requested", T0)), updates(("t", "accepted", T0 + 5)),
             updates(("t", "completed", T0 + 65), ("t", "in_progress", T0 + 15))]
    log = jobs.LifecycleLog(str(tmp_path / "trips"))
    io.drain(io.each_batch(as_batches(spark, tmp_path / "in", parts), log.write, str(tmp_path / "cp")))
    everything = parts[0].unionByName(parts[1]).unionByName(parts[2])
    columns = ["trip_id", "status", *[f"{s}_at" for s in lifecycle.STAGES]]
    want = rows(lifecycle.stage_times(everything), *columns)
    assert rows(log.trips(spark), *columns) == want
    log.compact(spark, str(tmp_path / "compact"))
    assert rows(jobs.LifecycleLog(str(tmp_path / "compact")).trips(spark), *columns) == want
    done = lifecycle.trip_lifecycle(everything).filter("trip_id = 't'").first()
    assert (done.status, done.wait_sec, done.pickup_sec, done.ride_sec) == ("completed", 5, 10, 50)


def test_blackouts(spark):
    data = [("x", i, T0 + s, st) for i, (s, st) in enumerate([
        (0, "moving"), (10, "blackout"), (700, "blackout"), (710, "blackout_recovered"), (900, "blackout"), (910, "idle"),
        (2000, "blackout")])]
    df = spark.createDataFrame(data, "taxi_id string, event_id int, s long, status string").withColumn(
        "event_time", F.timestamp_seconds("s"))
    got = [(r.pings, r.seconds, r.alert, r.recovered_at is None) for r in lifecycle.blackouts(df).orderBy("started_at").collect()]
    assert got == [(2, 700, True, False), (1, 10, False, False), (1, 0, False, True)]


def test_matching_over_several_batches(spark, tmp_path):
    pings, requests = city(7, 300, 80, 30, 0.3)
    p, r = frames(spark, pings, requests)
    both = p.withColumn("is_request", F.lit(False)).unionByName(
        r.select(F.col("request_id").alias("event_id"), F.lit(None).cast("long").alias("taxi_id"), "lat", "lon",
                 F.lit("requested").alias("status"), "event_time", "zone_id", F.lit(True).alias("is_request")))
    second = F.unix_timestamp("event_time") - 1_700_000_000
    parts = [both.filter(second.between(lo, lo + 499)) for lo in (0, 500, 1000)]
    matcher = jobs.Matcher(str(tmp_path / "log"), str(tmp_path / "matches"), str(tmp_path / "open"))
    io.drain(io.each_batch(as_batches(spark, tmp_path / "in", parts), matcher.write, str(tmp_path / "cp")))
    matcher.close(spark, len(parts) - 1)
    columns = ["request_id", "taxi_id", "ring", "taxi_zone"]
    assert rows(matcher.results(spark), *columns) == rows(match.match_nearest(r, p), *columns)
    assert matcher.publish(spark).count() == r.count()


def test_open_requests_meet_pings_that_come_a_batch_late(spark, tmp_path):
    def events(*items):
        return spark.createDataFrame(items, "event_id long, taxi_id long, s long, lat double, is_request boolean").select(
            "event_id", "taxi_id", F.timestamp_seconds("s").alias("event_time"), "lat", F.lit(-7.6).alias("lon"),
            F.lit(7).alias("zone_id"), F.lit("moving").alias("status"), "is_request")

    batches = [events((1, None, T0 + 60, 33.55, True), (2, 9, T0 + 61, 33.60, False)),
               events((3, 5, T0 + 50, 33.55, False), (4, None, T0 + 100, 33.59, True)),
               events((5, 6, T0 + 100, 33.59, False), (6, 7, T0 + 900, 33.59, False), (7, None, T0 + 905, 10.0, True))]
    for wait in (0, 120):
        matcher = jobs.Matcher(*(str(tmp_path / f"{name}{wait}") for name in ("log", "matches", "open")), wait=wait)
        for k, batch in enumerate(batches):
            matcher.write(batch, k)
            matcher.write(batch, k)
        matcher.close(spark, 2)
        got = {x.request_id: x.taxi_id for x in matcher.results(spark).collect()}
        assert matcher.results(spark).count() == 3 and got[1] == 5 and set(got) == {1, 4, 7}
        assert got[4] == (6 if wait else 9)  # at once the taxi known by then; the nearer one if it waits for late pings


def test_open_requests_outlast_empty_and_old_batches(spark, tmp_path):
    def events(*items):
        return spark.createDataFrame(items, "event_id long, taxi_id long, s long, is_request boolean").select(
            "event_id", "taxi_id", F.timestamp_seconds("s").alias("event_time"), F.lit(33.55).alias("lat"),
            F.lit(-7.6).alias("lon"), F.lit(7).alias("zone_id"), F.lit("moving").alias("status"), "is_request")

    for case, batches in enumerate([
            [events((1, None, T0 + 60, True)), events(), events((2, 5, T0 + 55, False))],  # nothing comes in between
            [events((1, None, T0 + 60, True)), events((2, 5, T0 + 55, False))]]):  # the ping is older than the request
        matcher = jobs.Matcher(*(str(tmp_path / f"{name}{case}") for name in ("log", "matches", "open")))
        for k, batch in enumerate(batches):
            matcher.write(batch, k)
            if k + 1 < len(batches):
                assert spark.read.parquet(f"{matcher.open}/{k}").count() == 1
        assert [(r.request_id, r.taxi_id) for r in matcher.results(spark).collect()] == [(1, 5)]


def test_messages_carry_their_key(spark):
    df = spark.createDataFrame([(7, 1.5)], "taxi_id long, lat double")
    row = io.as_messages(df, F.col("taxi_id")).first()
    assert row.key == "7" and json.loads(row.value) == {"taxi_id": 7, "lat": 1.5}


def test_counters_are_observed_on_the_stream(spark, tmp_path):
    df = spark.createDataFrame([("moving",), ("blackout",), ("blackout_recovered",)], "status string")
    stream = as_batches(spark, tmp_path / "in", [df]).observe("sent", *gps.counters())
    running = io.to_files(stream, str(tmp_path / "out"), str(tmp_path / "cp")).trigger(availableNow=True).start()
    running.awaitTermination()
    seen = [p.observedMetrics["sent"] for p in running.recentProgress if "sent" in p.observedMetrics]
    assert [(r.sent, r.recovered_blackouts, r.blackout_pings) for r in seen] == [(3, 1, 1)]
