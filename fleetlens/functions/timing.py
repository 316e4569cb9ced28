"""Event-time, calendar and demand-curve column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fleetlens import constants as K


def parse_iso(text: Column) -> Column:
    """ISO-8601 text with Z or offset to timestamp; null if it is not a full date."""
    return F.when(text.rlike(r"^\s*\d{4}-\d{2}-\d{2}"), text.try_cast("timestamp"))


def slot_index(epoch: Column, seconds: int = K.SLOT_SECONDS) -> Column:
    """Number of the slot that holds an epoch second."""
    return F.floor(epoch.cast("bigint") / seconds)


def slot_text(index: Column, seconds: int = K.SLOT_SECONDS) -> Column:
    """Start of a slot as text, e.g. ``2013-07-01 00:30:00``."""
    return F.from_unixtime(index * seconds)


def calendar(df, ts: str = "timestamp"):
    """Add hour, day_of_week (1 = Sunday), is_weekend, is_friday and date."""
    t = F.col(ts)
    dow = F.dayofweek(t)
    return df.withColumns({
        "hour": F.hour(t),
        "day_of_week": dow,
        "is_weekend": dow.isin(1, 7).cast("int"),
        "is_friday": (dow == 6).cast("int"),
        "date": F.to_date(t),
    })


def weekday_name(ts: Column) -> Column:
    return F.date_format(ts, "EEEE")


def demand_multiplier(ts: Column) -> Column:
    """Hourly demand curve, halved on Friday from 12h up to 14h."""
    curve = F.array(*[F.lit(v) for v in K.DEMAND_CURVE])
    start, end = K.FRIDAY_LUNCH_HOURS
    lunch = (F.dayofweek(ts) == 6) & (F.hour(ts) >= start) & (F.hour(ts) < end)
    return F.element_at(curve, F.hour(ts) + 1) * F.when(lunch, K.FRIDAY_LUNCH_REDUCTION).otherwise(1.0)


def request_delay_seconds(multiplier: Column, speed_factor: float = 1.0) -> Column:
    """Expected seconds between two requests under a demand multiplier."""
    usable = F.when(multiplier > 0, multiplier).otherwise(0.01)
    return F.greatest(
        F.lit(K.MIN_REQUEST_DELAY_SECONDS), F.lit(K.REQUEST_INTERVAL_SECONDS / speed_factor) / usable)


def requests_per_hour(multiplier: Column, speed_factor: float = 1.0) -> Column:
    return F.lit(3600.0) / request_delay_seconds(multiplier, speed_factor)
