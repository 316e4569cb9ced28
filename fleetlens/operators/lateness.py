"""Late events and duplicates in arrival order."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetlens import constants as K
from fleetlens.operators.ordered import Running, running
from fleetlens.session import materialize

ARRIVALS_PER_BLOCK = 100_000
#: Arrivals judged at once where each source has a watermark of its own.
ARRIVALS_PER_TASK = 100_000
IDLE_SECONDS = 30


def late_by_ms(event_ms: Column, max_before_ms: Column) -> Column:
    """Milliseconds behind the watermark; at most 0 is on time. The watermark trails the newest event
    seen before by the lateness bound plus one millisecond."""
    return max_before_ms - F.lit(K.LATENESS_MS + 1) - event_ms


def flag_late(
    events: DataFrame,
    arrival: str = "arrival",
    sources: list[str] | None = None,
    carried: Column | None = None,
) -> DataFrame:
    """Add ``max_before_ms``, ``is_late`` and ``late_by_sec``.

    ``arrival`` is a dense offset within each source. Without ``sources`` there is one watermark for all
    events. ``carried`` is the newest event time (ms) known from earlier batches, if any.
    """
    keys = sources or []
    ms = events.withColumn("__ms", F.unix_millis("event_time"))
    seen = running(
        ms, keys, [arrival], F.floor(F.col(arrival) / ARRIVALS_PER_BLOCK),
        {"max_before_ms": Running("max", F.col("__ms"), inclusive=False)})
    if carried is not None:
        seen = seen.withColumn("max_before_ms", F.greatest("max_before_ms", carried))
    behind = late_by_ms(F.col("__ms"), F.col("max_before_ms"))
    watermark = F.col("max_before_ms") - (K.LATENESS_MS + 1)
    late = F.coalesce((watermark > 0) & (behind > 0), F.lit(False))
    return seen.withColumns({
        "is_late": late,
        "late_by_sec": F.when(late, F.floor(behind / 1000)),
    }).drop("__ms")


def _least_watermark(source: np.ndarray, ms: np.ndarray, received: np.ndarray, seen: dict[int, tuple[int, int]],
                     idle_ms: int) -> np.ndarray:
    """Per arrival the least of the newest times of the sources that are not idle then, or the smallest number if all are.

    ``seen`` has the newest event time and the last arrival of each source before. Rows come in order.
    """
    least = np.iinfo(np.int64).min
    out = np.full(len(ms), np.iinfo(np.int64).max)
    some = np.zeros(len(ms), bool)
    for name in set(seen) | set(source.tolist()):
        before, last = seen.get(name, (least, least))
        own = source == name

        def until(values: np.ndarray, start: int) -> np.ndarray:
            return np.maximum.accumulate(np.concatenate([[start], np.where(own, values, least)]))[:-1]

        newest, heard = until(ms, before), until(received, last)
        awake = (heard > least) & (received - np.maximum(heard, 0) <= idle_ms)
        out = np.where(awake, np.minimum(out, newest), out)
        some |= awake
    return np.where(some, out, least)


def flag_late_by_source(events: DataFrame, arrival: str = "arrival", source: str = "source", received: str = "received_at",
                        idle_seconds: int = IDLE_SECONDS, past: DataFrame | None = None) -> DataFrame:
    """Add ``max_before_ms``, ``is_late`` and ``late_by_sec`` under one watermark over several sources.

    Each source has a newest event time; the watermark follows the least of them, and never goes back. A source
    from which nothing has arrived for ``idle_seconds`` (by ``received``) before an event holds nothing back; a
    slow one does. While all are idle the watermark stands still. A source counts from its first event on.

    ``arrival`` orders the events and ``received`` does not decrease along it; there are few sources, such as the
    partitions of a topic. Events are judged in blocks: what a block needs is the newest time and the last
    arrival per source before it, and then the highest watermark of the blocks before. ``past`` is the ``source_state``
    of the events before these.
    """
    rows = events.withColumns({
        "__block": F.floor(F.col(arrival) / ARRIVALS_PER_TASK), "__source": F.xxhash64(source),
        "__ms": F.unix_millis("event_time"), "__received": F.unix_millis(received)})
    sums = rows.groupBy("__block", "__source").agg(F.max("__ms").alias("ms"), F.max("__received").alias("received"))
    if past is not None:
        sums = sums.unionByName(past.select(
            F.lit(-1).cast("long").alias("__block"), F.xxhash64(source).alias("__source"), "ms", "received"))
    sums = materialize(sums, "arrivals-by-source")
    grid = sums.select("__block").distinct().filter("__block >= 0").join(sums.select("__source").distinct())
    both = grid.join(sums, ["__block", "__source"], "left").unionByName(sums.filter("__block < 0"))
    along = Window.partitionBy("__source").orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    carried = both.select("__block", "__source", F.max("ms").over(along).alias("ms"), F.max("received").over(along).alias("received")) \
        .filter("ms IS NOT NULL AND __block >= 0")
    idle_ms = idle_seconds * 1000

    def judged(block: pa.Table, known: pa.Table) -> pa.Table:
        block = block.sort_by(arrival)
        seen = {s: (m, r) for s, m, r in zip(*(known[c].to_pylist() for c in ("__source", "ms", "received")), strict=True)}
        least = _least_watermark(block["__source"].to_numpy(), block["__ms"].to_numpy(), block["__received"].to_numpy(), seen, idle_ms)
        least = np.maximum.accumulate(least)
        return block.append_column("__least", pa.array(least, mask=least == np.iinfo(np.int64).min))

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    inside = materialize(rows.groupBy("__block").cogroup(carried.groupBy("__block")).applyInArrow(
        judged, f"{fields}, __least long"), "arrivals-judged")
    blocks = inside.groupBy("__block").agg(F.max("__least").alias("m"))
    before = blocks.select("__block", F.max("m").over(
        Window.orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)).alias("__before"))
    start = F.lit(None).cast("long") if past is None else past.agg(F.max("watermark")).scalar()
    seen = inside.join(F.broadcast(before), "__block").withColumn("max_before_ms", F.greatest("__least", "__before", start))
    behind = late_by_ms(F.col("__ms"), F.col("max_before_ms"))
    late = F.coalesce((F.col("max_before_ms") > K.LATENESS_MS + 1) & (behind > 0), F.lit(False))
    return seen.withColumns({"is_late": late, "late_by_sec": F.when(late, F.floor(behind / 1000))}).drop(
        "__block", "__source", "__ms", "__received", "__least", "__before")


def source_state(judged: DataFrame, source: str = "source", received: str = "received_at", past: DataFrame | None = None) -> DataFrame:
    """source, ms, received, watermark: what later events need of the rows that ``flag_late_by_source`` has judged."""
    new = judged.groupBy(source).agg(
        F.max(F.unix_millis("event_time")).alias("ms"), F.max(F.unix_millis(received)).alias("received"),
        F.max("max_before_ms").alias("watermark"))
    if past is None:
        return new
    return new.unionByName(past).groupBy(source).agg(*[F.max(c).alias(c) for c in ("ms", "received", "watermark")])


def one_row_per_event(events: DataFrame, key: str = "event_id") -> DataFrame:
    """Of the rows with an id the first by the other columns, so that results repeat."""
    others = [c for c in events.columns if c != key]
    ranked = Window.partitionBy(key).orderBy(*(others or [key]))
    return events.withColumn("__n", F.row_number().over(ranked)).filter("__n = 1").drop("__n")
