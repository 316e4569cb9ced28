"""Zone dimension from GeoJSON, and the cell index used to look zones up.

The dimension is small by nature (city districts). The index holds one row per square cell, with the
few polygons that reach the cell, each with only the edges a point of that cell can need. A point then
meets exactly one index row, so zone assignment neither shuffles nor multiplies the points.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fleetlens import constants as K
from fleetlens import schemas
from fleetlens.functions import geo, text

CELL_DEG = 0.0025
_PAD = 1e-9  # cell borders are computed with rounding; edges this close belong to both sides


def read_features(spark: SparkSession, path: str) -> DataFrame:
    """Features of a GeoJSON file in file order."""
    file = spark.read.schema(schemas.GEO_COLLECTION).option("multiLine", True).json(path)
    return file.select(F.posexplode("features").alias("position", "feature")).select(
        "position", "feature.*")


def _polygons() -> Column:
    """Coordinates as polygons > rings > points, whatever the geometry type."""
    raw = F.col("geometry.coordinates")
    one = F.array(F.from_json(raw, "array<array<array<double>>>"))
    many = F.from_json(raw, "array<array<array<array<double>>>>")
    return F.when(F.col("geometry.type") == "Polygon", one).when(
        F.col("geometry.type") == "MultiPolygon", many)


def zone_dimension(
    features: DataFrame,
    ignored: list[str] = K.IGNORED_ZONE_NAMES,
    clean_names: bool = True,
) -> DataFrame:
    """One row per kept zone: seq, zone_id, name, prefecture, population, polygons, centroid.

    ``features`` needs position, properties and geometry. A zone without a numeric id gets its sequence
    number among the kept zones.
    """
    shapes = features.withColumn("polygons", _polygons()).filter(
        F.col("polygons").isNotNull() & (F.size(F.flatten("polygons")) > 0))
    props = F.col("properties")
    named = shapes.withColumn("raw_name", text.pick_property(props, K.NAME_KEYS))
    cleaned = text.clean_zone_name(F.col("raw_name"))
    label = F.lower(F.trim("raw_name"))
    kept = named.filter(
        F.col("raw_name").isNull() | ~(label.isin(ignored) | F.lower(cleaned).isin(ignored)))
    # The dimension is a list of districts, so numbering it in one task is cheap.
    numbered = kept.withColumn("seq", F.row_number().over(Window.orderBy("position")))
    label = F.coalesce("raw_name", F.concat(F.lit("zone_"), F.col("seq").cast("string")))
    points = F.flatten(F.flatten("polygons"))
    return numbered.select(
        "seq",
        F.coalesce(text.pick_property(props, K.ID_KEYS).try_cast("int"), F.col("seq")).alias("zone_id"),
        (text.clean_zone_name(label) if clean_names else label).alias("name"),
        F.coalesce(text.pick_property(props, K.PREFECTURE_KEYS), F.lit("")).alias("prefecture"),
        text.pick_property(props, K.POPULATION_KEYS).alias("population"),
        "polygons",
        _mean(F.transform(points, lambda p: p[0])).alias("centroid_lon"),
        _mean(F.transform(points, lambda p: p[1])).alias("centroid_lat"),
    )


def _mean(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, x: a + x) / F.size(values)


def bounding_box(zones: DataFrame) -> DataFrame:
    """One row: the box around all zone coordinates."""
    points = zones.select(F.explode(F.flatten(F.flatten("polygons"))).alias("p"))
    return points.agg(
        F.min(F.col("p")[0]).alias("min_lon"), F.max(F.col("p")[0]).alias("max_lon"),
        F.min(F.col("p")[1]).alias("min_lat"), F.max(F.col("p")[1]).alias("max_lat"))


def _attributes() -> Column:
    return F.struct("zone_id", "name", "prefecture", "population")


def _reaching_edges(edges: Column, lo_lat: Column, hi_lat: Column, lo_lon: Column) -> Column:
    """Edges a ray from inside the cell can cross: in its latitude strip and not left of it."""
    return F.filter(edges, lambda e: (
        (F.greatest(e.y, e.py) >= lo_lat) & (F.least(e.y, e.py) <= hi_lat)
        & (F.greatest(e.x, e.px) >= lo_lon)))


def _polygon_cells(zones: DataFrame, size: float) -> DataFrame:
    """One row per (cell, polygon whose box touches it) with the edges that matter there."""
    polygons = zones.repartition("seq").select(
        "seq", _attributes().alias("zone"), F.posexplode("polygons").alias("part", "rings")
    ).withColumns({
        "lons": F.transform(F.col("rings")[0], lambda p: p[0]),
        "lats": F.transform(F.col("rings")[0], lambda p: p[1]),
        "edges": F.transform("rings", geo.ring_edges),
    })

    def span(values: str) -> Column:
        lo = geo.cell(F.array_min(values) - _PAD, size)
        hi = geo.cell(F.array_max(values) + _PAD, size)
        return F.explode(F.sequence(lo, hi))

    cells = polygons.withColumn("cell_lat", span("lats")).withColumn("cell_lon", span("lons"))
    lo_lat, lo_lon = F.col("cell_lat") * size - _PAD, F.col("cell_lon") * size - _PAD
    hi_lat, hi_lon = lo_lat + size + 2 * _PAD, lo_lon + size + 2 * _PAD

    def near(edges: Column) -> Column:
        return _reaching_edges(edges, lo_lat, hi_lat, lo_lon)

    reaching = cells.select(
        "cell_lat", "cell_lon", "seq", "part", "zone",
        near(F.col("edges")[0]).alias("shell"),
        F.transform(F.slice("edges", 2, F.size("edges")), near).alias("holes"),
        F.exists(F.flatten("edges"), lambda e: _meets(e, lo_lat, hi_lat, lo_lon, hi_lon)).alias("border"))
    # Where no edge meets the cell, all its points are on the same side, and the centre tells which.
    mid_lat, mid_lon = (F.col("cell_lat") + 0.5) * size, (F.col("cell_lon") + 0.5) * size
    whole = ~F.col("border") & holds(F.col("shell"), F.col("holes"), mid_lat, mid_lon)
    return reaching.withColumn("whole", whole).filter(F.col("border") | F.col("whole")).drop("border")


def _meets(edge: Column, lo_lat: Column, hi_lat: Column, lo_lon: Column, hi_lon: Column) -> Column:
    """True unless the edge certainly stays outside the cell."""
    apart = (
        (F.greatest(edge.y, edge.py) < lo_lat) | (F.least(edge.y, edge.py) > hi_lat)
        | (F.greatest(edge.x, edge.px) < lo_lon) | (F.least(edge.x, edge.px) > hi_lon))

    def side(x: Column, y: Column) -> Column:
        return (edge.px - edge.x) * (y - edge.y) - (edge.py - edge.y) * (x - edge.x)

    corners = [side(x, y) for x in (lo_lon, hi_lon) for y in (lo_lat, hi_lat)]
    return ~(apart | (F.least(*corners) > 0) | (F.greatest(*corners) < 0))


def holds(shell: Column, holes: Column, lat: Column, lon: Column) -> Column:
    """True if the point is inside the shell and in none of the holes."""
    return geo.inside_ring(shell, lat, lon) & ~F.exists(holes, lambda h: geo.inside_ring(h, lat, lon))


def cell_index(zones: DataFrame, margin: float = K.BBOX_MARGIN_DEG, size: float = CELL_DEG) -> DataFrame:
    """One row per cell of the box plus margin.

    ``sure`` is the zone of the whole cell, if one zone holds it and comes first. Else ``polygons`` lists,
    in file order, what has to be tested per point, and ``near`` the zones whose centroid can be nearest.
    """
    shapes = (
        _polygon_cells(zones, size).groupBy("cell_lat", "cell_lon")
        .agg(F.sort_array(F.collect_list(
            F.struct("seq", "part", "whole", "zone", "shell", "holes"))).alias("polygons"))
        .withColumn("sure", F.when(F.col("polygons")[0].whole, F.col("polygons")[0].zone)))

    box = bounding_box(zones)
    centroids = zones.agg(F.sort_array(F.collect_list(F.struct(
        "seq", _attributes().alias("zone"), F.col("centroid_lon").alias("lon"),
        F.col("centroid_lat").alias("lat")))).alias("c")).scalar()

    def span(lo: str, hi: str) -> Column:
        return F.explode(F.sequence(
            geo.cell(F.col(lo) - margin - _PAD, size), geo.cell(F.col(hi) + margin + _PAD, size)))

    cells = (
        box.withColumn("cell_lat", span("min_lat", "max_lat"))
        .withColumn("cell_lon", span("min_lon", "max_lon"))
        .select("cell_lat", "cell_lon").repartition("cell_lat", "cell_lon")  # the join below needs it too
        .withColumn("all", centroids))
    lat0, lon0 = F.col("cell_lat") * size - _PAD, F.col("cell_lon") * size - _PAD
    lat1, lon1 = lat0 + size + 2 * _PAD, lon0 + size + 2 * _PAD

    def square(c: Column) -> Column:
        return c * c

    def closest(z: Column) -> Column:
        return (square(F.greatest(lat0 - z.lat, z.lat - lat1, F.lit(0.0)))
                + square(F.greatest(lon0 - z.lon, z.lon - lon1, F.lit(0.0))))

    def farthest(z: Column) -> Column:
        return (square(F.greatest(F.abs(z.lat - lat0), F.abs(z.lat - lat1)))
                + square(F.greatest(F.abs(z.lon - lon0), F.abs(z.lon - lon1))))

    # A centroid can be the nearest one for some point of the cell only if its closest corner is not
    # beyond the farthest corner of another centroid. The generator keeps the minimum from being
    # computed again for every element of the filter.
    bounded = cells.withColumn("reach", F.explode(F.array(F.array_min(F.transform("all", farthest)))))
    near = F.filter("all", lambda z: closest(z) <= F.col("reach") + _PAD)
    return bounded.withColumn("near", near).drop("all", "reach").join(shapes, ["cell_lat", "cell_lon"], "left")
