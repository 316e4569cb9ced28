import pytest
from pyspark.sql import functions as F

from conftest import rows
from fleetlens.operators import demand, features, forecast


@pytest.fixture(scope="module")
def slots(spark):
    """Zone 1 has demand in every slot of 12 months of days, zone 2 misses every fifth slot."""
    full = spark.range(48 * 40).select(F.lit(1).alias("zone_id"), (F.col("id") + 800_000).alias("slot"))
    holes = full.filter("slot % 5 <> 0").withColumn("zone_id", F.lit(2))
    df = full.unionByName(holes).withColumn("demand", F.col("slot") % 48 + F.col("slot") % 7)
    return df.withColumn("slot_30min", F.from_unixtime(F.col("slot") * 1800))


def test_slots_count_trips(spark):
    trips = spark.createDataFrame([(1, "1372636858"), (1, "1372636859"), (1, "1372640458")], "zone_id int, TIMESTAMP string")
    got = rows(demand.demand_slots(trips), "zone_id", "slot_30min", "demand")
    assert got == [(1, "2013-07-01 00:00:00", 2), (1, "2013-07-01 01:00:00", 1)]


def test_row_lags_and_time_lags_differ_only_with_gaps(slots):
    by_row = features.features_rowlag(slots)
    by_time = features.features_timelag(slots)
    assert rows(by_row.filter("zone_id = 1")) == rows(by_time.filter("zone_id = 1"))
    lagged = by_time.filter("zone_id = 2").select("slot_30min", "target", "demand_lag_1d", "demand_lag_7d").collect()
    series = {r.slot_30min: r.target for r in features.fill_gaps(slots).filter("zone_id = 2")
              .withColumnRenamed("demand", "target").collect()}
    keys = sorted(series)
    at = {k: i for i, k in enumerate(keys)}
    for r in lagged:
        assert r.demand_lag_1d == series[keys[at[r.slot_30min] - 48]]
        assert r.demand_lag_7d == series[keys[at[r.slot_30min] - 336]]
    assert any(r.target == 0 for r in lagged)


def test_request_features_equal_training_features(slots):
    trained = features.features_timelag(slots)
    requests = trained.select("zone_id", F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss").alias("datetime"))
    asked = features.request_features(requests, slots)
    columns = ["zone_id", "hour", "day_of_week", "is_weekend", "is_friday", "demand_lag_1d", "demand_lag_7d"]
    assert rows(asked, *columns) == rows(trained, *columns)
    ours = rows(asked.select("zone_id", "datetime", F.round("rolling_7d_mean", 9)))
    theirs = rows(trained.select("zone_id", F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss"), F.round("rolling_7d_mean", 9)))
    assert ours == theirs


def test_request_without_a_week_of_history_has_no_lags(slots):
    requests = slots.filter("zone_id = 1").orderBy("slot").limit(1).select("zone_id", F.col("slot_30min").alias("datetime"))
    row = features.request_features(requests, slots).first()
    assert row.demand_lag_7d is None and row.hour is not None


def test_months_are_split_in_order(spark):
    df = spark.sql("SELECT timestamp'2020-01-15' + make_interval(0, CAST(id AS INT)) AS timestamp FROM range(12)")
    split = features.split_by_month(df).orderBy("month").collect()
    assert [r.is_train for r in split] == [True] * 10 + [False] * 2


def test_model_roundtrip_and_report(spark, slots, tmp_path):
    rows_ = features.features_timelag(slots).withColumn("is_train", F.dayofmonth("timestamp") > 5)
    model = forecast.train(rows_, maxIter=5)
    path = str(tmp_path / "model")
    report = forecast.evaluate(model, rows_)
    forecast.save_model(model, path, report)
    again = forecast.load_model(path)
    a, b = (rows(forecast.predict(m, rows_), "zone_id", "slot_30min", "prediction") for m in (model, again))
    assert a == b
    saved = spark.read.json(f"{path}_metrics").first()
    assert saved.rmse >= 0 and saved.rmse_naive > 0
    assert saved.improvement_pct == pytest.approx((saved.rmse_naive - saved.rmse) / saved.rmse_naive * 100)
    assert forecast.importances(model, spark).agg(F.sum("importance")).first()[0] == pytest.approx(1.0)


def test_spikes_need_three_times_the_usual(spark):
    data = [(1, s * 300) for s in range(24)] + [(1, 24 * 300 + i) for i in range(3)]
    requests = spark.createDataFrame(data, "zone_id int, s long").withColumn("event_time", F.timestamp_seconds("s"))
    got = demand.demand_spikes(requests).collect()
    late = [r for r in got if r.requests == 3]
    assert len(late) == 1 and late[0].usual == 1.0
