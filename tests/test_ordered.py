import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import rows
from fleetlens.operators import trajectory as t
from fleetlens.operators.ordered import Running, drop_halo, running, with_halo


def skewed(spark, n=600):
    """One key holds most rows."""
    rng = random.Random(3)
    data = [("hot" if rng.random() < 0.7 else f"k{rng.randint(0, 9)}", i, rng.randint(-50, 50)) for i in range(n)]
    return spark.createDataFrame(data, "k string, pos int, v int")


def test_running_equals_a_plain_window(spark):
    df = skewed(spark)
    for backwards in (False, True):
        for inclusive in (True, False):
            got = running(
                df, ["k"], ["pos"], F.floor(F.col("pos") / 17),
                {name: Running(kind, F.col("v"), backwards, inclusive)
                 for name, kind in (("hi", "max"), ("lo", "min"), ("total", "sum"))})
            order = F.col("pos").desc() if backwards else F.col("pos")
            w = Window.partitionBy("k").orderBy(order).rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
            want = df.select("k", "pos", "v", F.max("v").over(w), F.min("v").over(w),
                             F.coalesce(F.sum("v").over(w), F.lit(0)))
            assert rows(got, "k", "pos", "v", "hi", "lo", "total") == rows(want)


def test_running_without_keys(spark):
    df = skewed(spark)
    got = running(df, [], ["pos"], F.floor(F.col("pos") / 50), {"hi": Running("max", F.col("v"), inclusive=False)})
    w = Window.orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    assert rows(got, "pos", "hi") == rows(df.select("pos", F.max("v").over(w)))


def test_halo_gives_each_row_its_neighbours(spark):
    df = spark.range(100).select(F.col("id").cast("int").alias("pos"))
    near = with_halo(df, F.col("pos"), 10, before=2, after=3)
    w = Window.partitionBy("__block").orderBy("pos").rangeBetween(-2, 3)
    got = drop_halo(near.withColumn("n", F.sum("pos").over(w)))
    want = {p: sum(range(max(0, p - 2), min(99, p + 3) + 1)) for p in range(100)}
    assert {r.pos: r.n for r in got.collect()} == want


def test_long_trips_are_cut_without_a_trace(spark, monkeypatch):
    rng = random.Random(5)
    line = [[-7.6 + rng.uniform(-0.05, 0.05), 33.55 + rng.uniform(-0.05, 0.05)] for _ in range(50)]
    trips = spark.createDataFrame([(1, line), (2, line[:3])], "trip_id long, polyline array<array<double>>")
    points = t.explode_points(trips)
    whole = [rows(f(points)) for f in (t.point_speeds, t.segments, lambda p: t.smooth(p, 3), t.adaptive_sample)]
    monkeypatch.setattr(t, "POINTS_PER_BLOCK", 7)
    cut = [rows(f(points)) for f in (t.point_speeds, t.segments, lambda p: t.smooth(p, 3), t.adaptive_sample)]
    assert whole == cut
    columns = ["trip_id", "point_index", "speed", "status"]
    assert rows(t.point_speeds(points), *columns) == rows(t.trip_speeds(trips), *columns)
