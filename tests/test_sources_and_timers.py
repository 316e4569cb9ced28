"""One watermark over several sources, and alerts while something lasts."""

import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from fleetlens.operators import lateness
from fleetlens.streaming import io, jobs, timers
from fleetlens.streaming.normalizer import SourceWatermark

T0 = 1_704_103_200  # 2024-01-01 10:00:00 UTC
EVENTS = "arrival long, source string, received_at long, event_time long"


def frame(spark, data):
    return spark.createDataFrame(data, EVENTS).withColumns({
        c: F.timestamp_seconds(F.col(c) + T0) for c in ("received_at", "event_time")})


def judged(data, idle=30):
    """(arrival, watermark's newest time, late) by a plain scan."""
    newest, heard, mark, out = {}, {}, None, []
    for arrival, source, received, time in sorted(data):
        awake = [newest[s] for s in newest if received - heard[s] <= idle]
        if awake and (mark is None or min(awake) > mark):
            mark = min(awake)
        out.append((arrival, None if mark is None else (mark + T0) * 1000, mark is not None and (mark - time) * 1000 > 180_001))
        newest[source] = max(newest.get(source, time), time)
        heard[source] = received
    return out


def test_a_silent_source_holds_nothing_back_and_a_slow_one_does(spark):
    data = [(0, "slow", 0, 400), (1, "fast", 1, 1000), (2, "fast", 2, 1600), (3, "fast", 3, 700),  # slow is at 400: 700 is on time
            (4, "fast", 32, 1700), (5, "fast", 33, 700)]  # slow has said nothing for 32 s: 700 is late
    got = {r.arrival: (r.is_late, r.late_by_sec) for r in lateness.flag_late_by_source(frame(spark, data)).collect()}
    assert got == {0: (False, None), 1: (False, None), 2: (False, None), 3: (False, None), 4: (False, None), 5: (True, 819)}


def crowd(n=400):
    draw, received, data = random.Random(6), 0, []
    for k in range(n):
        received += draw.choice((0, 1, 2, 12, 45))
        source = draw.choice("abc" if k % 100 < 60 else "ab")
        data.append((k, source, received, received + draw.choice((0, -100, -200, -500)) - (150 if source == "c" else 0)))
    return data


@pytest.mark.parametrize("size", [7, 100_000])
def test_equals_a_scan(spark, monkeypatch, size):
    monkeypatch.setattr(lateness, "ARRIVALS_PER_TASK", size)
    data = crowd()
    got = lateness.flag_late_by_source(frame(spark, data))
    assert sorted((r.arrival, r.max_before_ms, r.is_late) for r in got.collect()) == judged(data)
    assert any(late for *_, late in judged(data))


def test_batches_equal_one_pass(spark, tmp_path):
    data = crowd(120)
    marks = SourceWatermark(str(tmp_path / "state"))
    got = []
    for batch_id in range(4):
        part = frame(spark, data[30 * batch_id:30 * batch_id + 30])
        for _ in range(1 + batch_id % 2):  # a repeated batch sees the same past
            out = marks.apply(part, batch_id)
        got += [(r.arrival, r.max_before_ms, r.is_late) for r in out.collect()]
    assert sorted(got) == judged(data)


def replayed(spark, tmp_path, parts, schema, make):
    """Each part is a micro-batch of a stream that goes on; what the sink holds after each of them."""
    seen = []
    for part in parts:
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        source = io.read_files(spark, str(tmp_path / "in"), spark.createDataFrame([], schema).schema)
        io.drain(io.to_files(make(source), str(tmp_path / "out"), str(tmp_path / "cp")))
        seen.append(rows(spark.read.parquet(str(tmp_path / "out"))) if list((tmp_path / "out").glob("*.parquet")) else [])
    return seen


def test_blackout_alert_comes_while_it_lasts(spark, tmp_path):
    parts = [
        [("never ends", 1, 0, "blackout"), ("over in time", 2, 0, "blackout"), ("late recovery", 3, 0, "blackout"), ("exact", 4, 0, "blackout")],
        [("over in time", 6, 119, "moving"), ("never ends", 5, 60, "blackout"), ("late recovery", 8, 121, "idle"), ("exact", 9, 120, "idle"),
         ("clock", 7, 299, "idle")],  # the watermark is at 119 s
        [("clock", 10, 420, "idle")],
        [("never ends", 11, 500, "blackout"), ("late recovery", 12, 500, "blackout"), ("clock", 13, 2000, "idle")],
        [("clock", 14, 4000, "idle")]]

    def make(stream):
        events = stream.select("taxi_id", "event_id", F.timestamp_seconds(F.col("s") + T0).alias("event_time"), "status")
        alerts = timers.blackout_alerts(jobs.watermarked(events), alert_seconds=120)
        return alerts.select("taxi_id", *[(F.unix_timestamp(c) - T0).alias(c) for c in ("started_at", "overdue_at")])

    seen = replayed(spark, tmp_path, parts, "taxi_id string, event_id long, s long, status string", make)
    assert seen[1] == []
    assert seen[2] == [("late recovery", 0, 120), ("never ends", 0, 120)]
    assert seen[-1] == sorted([*seen[2], ("late recovery", 500, 620)])


def test_a_trip_that_is_stuck(spark, tmp_path):
    parts = [[(1, "requested", 0), (2, "requested", 0), (3, "completed", 0), (2, "accepted", 50), (None, "requested", 0)],
             [(2, "in_progress", 500), (9, "completed", 3000)], [(9, "completed", 9000)]]

    def make(stream):
        updates = stream.select("trip_id", "status", F.timestamp_seconds(F.col("s") + T0).alias("event_time"))
        return timers.stuck_trips(jobs.watermarked(updates), {"requested": 100, "accepted": 400}).select(
            "trip_id", "status", (F.unix_timestamp("overdue_at") - T0).alias("overdue"))

    seen = replayed(spark, tmp_path, parts, "trip_id long, status string, s long", make)
    assert seen[-1] == [("1", "requested", 100), ("2", "accepted", 450)]
