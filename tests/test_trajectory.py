import pytest
from pyspark.sql import functions as F

from fleetlens import schemas
from fleetlens.operators import curate, trajectory as t
from fleetlens.sources import files

LINE = [[-7.60, 33.55], [-7.60, 33.56], [-7.60, 33.56], [-7.50, 33.56]]


@pytest.fixture
def trips(spark):
    return spark.createDataFrame([(1, LINE), (2, [[-7.8, 33.5]]), (3, [])], "trip_id long, polyline array<array<double>>")


def test_speeds(trips):
    got = {(r.trip_id, r.point_index): (r.speed, r.status) for r in t.trip_speeds(trips).collect()}
    assert got[(1, 0)] == (0.0, "idle") and got[(1, 2)] == (0.0, "idle") and got[(2, 0)] == (0.0, "idle")
    assert got[(1, 1)] == (266.9, "moving") and len(got) == 5


def test_segments_start_at_long_steps(trips):
    got = [r.segment for r in t.segments(t.explode_points(trips).filter("trip_id = 1"), 5.0).orderBy("point_index").collect()]
    assert got == [0, 0, 0, 1]


def test_boxes(trips):
    clamped = trips.select("trip_id", t.clamp_to_box(F.col("polyline")).alias("p")).filter("trip_id = 2").first().p
    assert clamped == [[-7.73, 33.5]]
    kept = trips.select(F.size(t.drop_outliers(F.col("polyline"))).alias("n"), "trip_id").orderBy("trip_id").collect()
    assert [r.n for r in kept] == [3, 0, 0]
    moved = trips.filter("trip_id = 1").select(
        t.remap_box(F.col("polyline"), (33.0, 34.0, -8.0, -7.0), (0.0, 10.0, 0.0, 100.0)).alias("p")).first().p
    assert moved[0] == pytest.approx([40.0, 5.5])


def test_ends_and_estimates(trips):
    row = t.estimates(t.origin_destination(trips.filter("trip_id = 1"))).first()
    assert (row.origin.lat, row.destination.lon, row.num_gps_points) == (33.55, -7.50, 4)
    assert row.estimated_duration_min == pytest.approx(row.estimated_distance_km / 25 * 60)


def test_trajectory_files_are_checked(spark, tmp_path, trips):
    path = str(tmp_path / "t")
    trips.write.parquet(path)
    assert files.read_trajectories(spark, path, trips.schema).count() == 1
    with pytest.raises(ValueError):
        curate.trajectory_schema_check(trips.drop("polyline"))
    with pytest.raises(ValueError):
        curate.trajectory_schema_check(trips.withColumn("polyline", F.lit("x")))


def test_csv_fixture(spark, tmp_path):
    three = "[[-7.60,33.55],[-7.61,33.56],[-7.62,33.57]]"
    data = [("t1", three), ("t1", three), ("t2", "[]"), ("t3", None), ("t4", "[[-7.60,33.55]]")]
    raw = spark.createDataFrame(
        [(i, "A", "9", "1372636858", "A", p) for i, p in data], schemas.RAW_TRIP)
    files.write_trips_csv(raw, str(tmp_path / "csv"))
    read = files.read_trips_csv(spark, str(tmp_path / "csv"))
    assert all(f.dataType.simpleString() == "string" for f in read.schema.fields)
    got = {r.TRIP_ID: r.trip_duration_sec for r in curate.curate_trips(read).collect()}
    assert got == {"t1": 45, "t4": 15}
    counts = curate.stage_counts(read).first()
    assert tuple(counts) == (5, 4, 3, 2)


def test_observed_counts_need_no_extra_job(spark):
    df, seen = curate.observe_rows(spark.range(10).filter("id > 3"), "kept")
    df.write.format("noop").mode("overwrite").save()
    assert seen.get["rows"] == 6


def test_hot_trip_ids_are_cut_before_the_shuffle(spark):
    raw = spark.createDataFrame([("t", "1", "p")], "TRIP_ID string, TIMESTAMP string, POLYLINE string")
    plan = curate.one_row_per_trip(raw)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_smoothing_is_right_beyond_a_block(spark):
    points = spark.range(30_000).select(
        F.lit("t").alias("trip_id"), F.col("id").alias("point_index"), F.col("id").cast("double").alias("lat"),
        F.col("id").cast("double").alias("lon"))
    got = t.smooth(points, 9000).filter("point_index = 10000").first()
    assert got["smooth_lat"] == 10000.0
