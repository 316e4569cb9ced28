"""Cleaning and normalising of GPS events. The same functions serve batch tables and streams."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlens import constants as K
from fleetlens import schemas
from fleetlens.functions import geo, text, timing
from fleetlens.session import fixed_rows, materialize, small_side
from fleetlens.sources import zones as zs


@dataclass(frozen=True)
class NormalizeOptions:
    """``grid`` uses the fixed box and 4x4 grid, ``polygon`` the zone polygons."""

    zone_mode: str = "polygon"
    nearest_fallback: bool = True
    clean_names: bool = True
    admin_attrs: bool = True


GRID = NormalizeOptions(zone_mode="grid")
POLYGON_RAW_NAMES = NormalizeOptions(clean_names=False)
POLYGON_STRICT = NormalizeOptions(nearest_fallback=False, admin_attrs=False)
POLYGON = NormalizeOptions()


def parse_gps(raw: DataFrame, value: str = "value") -> DataFrame:
    """Typed GPS columns from JSON text, with ``reject_reason`` set on unusable rows.

    Other columns of ``raw`` (offset, partition, ...) are kept, as ``source_...`` where the event has a
    field of that name.
    """
    fields = set(schemas.GPS_EVENT.fieldNames())
    raw = raw.withColumnsRenamed({c: f"source_{c}" for c in raw.columns if c != value and c in fields})
    others = [F.col(c) for c in raw.columns if c != value]
    e = F.from_json(F.col(value).cast("string"), schemas.GPS_EVENT)
    # As a generator the JSON text is parsed once per row; as a plain column, filters on the fields
    # would be pushed below it together with copies of the parser.
    named = raw.select(*others, F.inline(F.array(e)))
    stamp = F.coalesce(F.nullif("timestamp_utc", F.lit("")), F.nullif("timestamp", F.lit("")))
    typed = named.select(
        *others,
        F.coalesce("taxi_id", "vehicle_id", F.lit("unknown")).alias("taxi_id"),
        stamp.alias("__stamp"),
        timing.parse_iso(stamp).alias("event_time"),
        F.coalesce("lat", "latitude").try_cast("double").alias("lat"),
        F.coalesce("lon", "longitude").try_cast("double").alias("lon"),
        F.coalesce("speed", F.lit("0.0")).try_cast("double").alias("speed"),
        F.coalesce("status", F.lit("unknown")).alias("status"),
        "event_id", "trip_id", "vehicle_id", "origin_zone", "destination_zone", "anomaly_type",
    )

    def unusable(c: str) -> Column:
        return F.col(c).isNull() | F.isnan(c)

    reason = (
        F.when(F.col("__stamp").isNull(), "missing_timestamp")
        .when(F.col("event_time").isNull(), "bad_timestamp")
        .when(unusable("lat") | unusable("lon"), "bad_position")
        .when(unusable("speed"), "bad_speed")
        .when(F.col("speed") < 0, "negative_speed"))
    return typed.withColumn("reject_reason", reason).drop("__stamp")


def cap_speed(df: DataFrame) -> DataFrame:
    """Replace speeds above 70 by a value in 20.0..70.0 that depends on the event only."""
    key = F.coalesce("event_id", F.concat_ws("|", "taxi_id", F.unix_micros("event_time").cast("string")))
    steps = int((K.MAX_SPEED_KMH - K.MIN_REALISTIC_SPEED_KMH) * 10) + 1
    stand_in = F.lit(K.MIN_REALISTIC_SPEED_KMH) + text.stable_number(key, steps) / 10
    return df.withColumn("speed", F.when(F.col("speed") > K.MAX_SPEED_KMH, stand_in).otherwise(F.col("speed")))


def with_grid_zone(df: DataFrame) -> DataFrame:
    return df.withColumn("zone_id", geo.grid_zone(F.col("lat"), F.col("lon")))


class ZoneLookup:
    """Polygon lookup prepared once per job or stream start from the zone dimension."""

    def __init__(self, zones: DataFrame, margin: float = K.BBOX_MARGIN_DEG):
        self.margin = margin
        kept = materialize(zones, "zones")
        self.box = zs.bounding_box(kept)
        self.index = small_side(materialize(zs.cell_index(kept, margin), "zone-cells"))

    def inside_box(self, df: DataFrame) -> Column:
        """Inclusive test against the box around all zones, widened by the margin."""
        def bound(name: str, shift: float) -> Column:
            return self.box.select(F.col(name) + shift).scalar()
        return (
            F.col("lat").between(bound("min_lat", -self.margin), bound("max_lat", self.margin))
            & F.col("lon").between(bound("min_lon", -self.margin), bound("max_lon", self.margin)))

    def assign(self, df: DataFrame, nearest_fallback: bool = True) -> DataFrame:
        """Add ``zone`` (zone_id, name, prefecture, population): first polygon in file order that holds
        the point, else the nearest centroid if asked for, else null."""
        cells = df.withColumns({
            "cell_lat": geo.cell(F.col("lat"), zs.CELL_DEG), "cell_lon": geo.cell(F.col("lon"), zs.CELL_DEG)})
        joined = cells.join(self.index, ["cell_lat", "cell_lon"], "left")
        lat, lon = F.col("lat"), F.col("lon")

        hits = F.filter("polygons", lambda p: p.whole | zs.holds(p.shell, p.holes, lat, lon))
        zone = F.coalesce("sure", F.get(hits, F.lit(0)).zone)
        if nearest_fallback:
            def ranked(z: Column) -> Column:
                d2 = (lon - z.lon) * (lon - z.lon) + (lat - z.lat) * (lat - z.lat)
                return F.struct(d2.alias("d2"), z.seq.alias("seq"), z.zone.alias("zone"))
            nearest = F.when(F.size("near") == 1, F.col("near")[0].zone).otherwise(
                F.array_min(F.transform("near", ranked)).zone)
            zone = F.coalesce(zone, nearest)
        return joined.withColumn("zone", zone).drop(
            "cell_lat", "cell_lon", "sure", "near", "polygons")


def normalize(events: DataFrame, options: NormalizeOptions = POLYGON, lookup: ZoneLookup | None = None) -> DataFrame:
    """Keep usable events inside the city and attach their zone. ``events`` comes from ``parse_gps``."""
    usable = cap_speed(events.filter(F.col("reject_reason").isNull()))
    if options.zone_mode == "grid":
        inside = usable.filter(geo.in_city_box(F.col("lat"), F.col("lon")))
        return with_grid_zone(inside).withColumn("city", F.lit(K.CITY)).drop("reject_reason")
    if lookup is None:
        raise ValueError("polygon mode needs a ZoneLookup")
    placed = lookup.assign(usable.filter(lookup.inside_box(usable)), options.nearest_fallback)
    if not options.nearest_fallback:
        placed = placed.filter(F.col("zone").isNotNull())
    zoned = placed.withColumns({
        "city": F.lit(K.CITY), "zone_id": F.col("zone.zone_id"), "arrondissement": F.col("zone.name")})
    if options.admin_attrs:
        zoned = zoned.withColumns({
            "prefecture": F.col("zone.prefecture"), "zone_population": F.col("zone.population")})
    return zoned.drop("zone", "reject_reason")


OUTPUT_FIELDS = [
    "city", "zone_id", "arrondissement", "prefecture", "zone_population", "event_time", "taxi_id",
    "lat", "lon", "speed", "status", "trip_id", "vehicle_id", "origin_zone", "destination_zone",
]


def output_fields(normalized: DataFrame) -> DataFrame:
    """The published event: its fields in order, without those the chosen options do not fill."""
    return normalized.select(*[c for c in OUTPUT_FIELDS if c in normalized.columns])


def rejects(events: DataFrame) -> DataFrame:
    """Unusable rows with their reason, for a side output."""
    return events.filter(F.col("reject_reason").isNotNull())


def counters() -> list[Column]:
    """Published events and recovered blackouts, for ``agg`` or for ``observe`` on a running stream."""
    return [
        F.count(F.lit(1)).alias("sent"),
        F.count_if(F.col("status") == "blackout_recovered").alias("recovered_blackouts"),
        F.count_if(F.col("status") == "blackout").alias("blackout_pings")]


def representative_points(df: DataFrame, zone: str = "zone_id") -> DataFrame:
    """Add the representative point of a zone, or the default point if the zone has none."""
    points = fixed_rows(
        df.sparkSession, [zone, "zone_lat", "zone_lon"],
        [(z, lat, lon) for z, (lat, lon) in K.ZONE_POINTS.items()])
    lat, lon = K.DEFAULT_ZONE_POINT
    return df.join(F.broadcast(points), zone, "left").withColumns({
        "zone_lat": F.coalesce("zone_lat", F.lit(lat)), "zone_lon": F.coalesce("zone_lon", F.lit(lon))})


def points_per_zone(df: DataFrame) -> DataFrame:
    return df.groupBy("zone_id").agg(F.count(F.lit(1)).alias("points"))


def latest_positions(positions: DataFrame, city: str, zone_id: int, n: int = 10) -> DataFrame:
    """The n newest positions of a zone. On a table partitioned by (city, zone_id) only that folder is read."""
    return (
        positions.filter((F.col("city") == city) & (F.col("zone_id") == zone_id))
        .orderBy(F.desc("event_time"), "taxi_id", "lat", "lon").limit(n))
