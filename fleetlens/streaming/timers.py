"""Alerts while something lasts: event time timeouts over groups of keys."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from fleetlens import constants as K
from fleetlens.operators.lifecycle import STAGES

KEY_GROUPS = 256  # keys share a state, which makes one call of many


def overdue_runs(events: DataFrame, key: str, state: Column, rank: Column, limits: dict[str, int],
                 groups: int = KEY_GROUPS) -> DataFrame:
    """``key`` (as text), state, started_at, overdue_at: one row for each run that outlasts its limit in seconds.

    ``events`` is a stream with a watermark on event_time. A run is a sequence of events of a key with the same
    state, by event_time and then ``rank``. The row comes when the watermark passes overdue_at, also for a run that
    never ends; a run that has been over by then has none. Rows without a key, time or state are left out.

    Events wait in state until the watermark has passed them, and are then taken in order of time; of a key no more
    is held than the events of the watermark's delay and its current run. A run in a state without a limit is
    forgotten, so finished keys leave nothing behind. Keys are spread over ``groups`` by hash, and a call takes all keys
    of a group at once; the number must stay the same as long as a checkpoint is used. Any state store will do.
    """
    rows = events.select(
        F.col(key).cast("string").alias("key"), "event_time", F.unix_micros("event_time").alias("at"),
        rank.cast("long").alias("rank"), state.alias("state")).filter("key IS NOT NULL AND at IS NOT NULL AND state IS NOT NULL")
    allowed = {name: seconds * 1_000_000 for name, seconds in limits.items()}
    run, reported, waits = 0, 1, 2

    def follow(group: Any, frames: Iterator[pd.DataFrame], held: GroupState) -> Iterator[pd.DataFrame]:
        now = held.getCurrentWatermarkMs() * 1000
        new = [f[["key", "at", "rank", "state"]].assign(kind=waits) for f in frames]
        if held.exists:
            new.append(pa.ipc.open_stream(held.get[0]).read_all().to_pandas())
        known = pd.concat(new, ignore_index=True).astype({"rank": "Int64"})
        later = known[(known["kind"] == waits) & (known["at"] > now)]
        # a key's current run comes before its events, which are in order of time, rank and state
        known = known.drop(later.index).sort_values(["key", "kind", "at", "rank", "state"], na_position="first")
        same_key = (known["key"] == known["key"].shift()).to_numpy(bool)
        runs = known[~(same_key & (known["state"] == known["state"].shift()).to_numpy(bool))]
        last = (runs["key"] != runs["key"].shift(-1)).to_numpy(bool)
        until = (runs["at"] + runs["state"].map(allowed)).to_numpy(float, na_value=np.nan)
        limited = ~np.isnan(until)
        until = np.where(limited, until, 0).astype(np.int64)
        ended = runs["at"].shift(-1, fill_value=0).to_numpy(np.int64)
        over = limited & (runs["kind"] != reported).to_numpy(bool) & np.where(last, now >= until, ended > until)
        found = pd.DataFrame({"key": runs["key"], "state": runs["state"], "started": runs["at"], "until": until})[over]
        current = runs[last & limited].assign(
            kind=np.where(over | (runs["kind"] == reported).to_numpy(bool), reported, run)[last & limited])
        kept = pd.concat([current, later], ignore_index=True)
        if kept.empty:
            held.remove()
        else:
            table = pa.table({
                "key": pa.array(kept["key"], pa.string()), "at": pa.array(kept["at"], pa.int64()),
                "rank": pa.array(kept["rank"], pa.int64()), "state": pa.array(kept["state"], pa.string()),
                "kind": pa.array(kept["kind"], pa.int8())})
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, table.schema) as out:
                out.write_table(table)
            held.update((sink.getvalue().to_pybytes(),))
            due = [*later["at"].tolist(), *until[last & limited][(current["kind"] == run).to_numpy(bool)].tolist()]
            if due:  # a timeout comes when the watermark is past it, an event is due when the watermark has reached it
                held.setTimeoutTimestamp(-(-min(due) // 1000) - 1)
        yield found

    found = rows.withColumn("group", F.pmod(F.xxhash64("key"), F.lit(groups))).groupBy("group").applyInPandasWithState(
        follow, "key string, state string, started long, until long", "held binary", "append", GroupStateTimeout.EventTimeTimeout)
    return found.select(F.col("key").alias(key), "state", F.timestamp_micros("started").alias("started_at"),
                        F.timestamp_micros("until").alias("overdue_at"))


def blackout_alerts(events: DataFrame, alert_seconds: int = K.BLACKOUT_ALERT_SECONDS) -> DataFrame:
    """taxi_id, started_at, overdue_at: a vehicle that has been dark for longer than the limit, while it still is.

    ``events``: taxi_id, event_id, event_time, status; raw events with a watermark.
    """
    dark = F.when(F.col("status") == "blackout", "dark").otherwise("seen")
    return overdue_runs(events, "taxi_id", dark, F.col("event_id"), {"dark": alert_seconds}).drop("state")


def stuck_trips(updates: DataFrame, limits: dict[str, int]) -> DataFrame:
    """trip_id, status, started_at, overdue_at: trips that stay in a stage for longer than its limit in seconds.

    ``updates``: trip_id, status, event_time with a watermark. At equal times the later stage counts as newer.
    """
    rank = F.array_position(F.array(*[F.lit(s) for s in STAGES]), F.col("status"))
    return overdue_runs(updates, "trip_id", F.col("status"), rank, limits).withColumnRenamed("state", "status")
