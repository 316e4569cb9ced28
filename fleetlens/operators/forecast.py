"""Gradient-boosted demand forecast on MLlib."""

from __future__ import annotations

from functools import reduce

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens import constants as K
from fleetlens.operators.features import naive_forecast, rmse
from fleetlens.session import materialize


def _complete(columns: list[str]) -> Column:
    return reduce(Column.__and__, [F.col(c).isNotNull() for c in columns])


def assemble(features: DataFrame, columns: list[str] = K.FEATURE_COLUMNS) -> DataFrame:
    """Add the feature vector. Rows with a missing feature must have been filtered or filled."""
    return VectorAssembler(inputCols=columns, outputCol="features").transform(features)


def train(split: DataFrame, columns: list[str] = K.FEATURE_COLUMNS, **params) -> GBTRegressionModel:
    """Fit on the training months. The few numbers needed are written once, since boosting reads them often."""
    rows = assemble(split.filter("is_train").filter(_complete(columns)), columns).select("zone_id", "features", "target")
    learner = GBTRegressor(featuresCol="features", labelCol="target", **{**K.GBT_PARAMS, **params})
    return learner.fit(materialize(rows, "train"))


def predict(model: GBTRegressionModel, features: DataFrame, columns: list[str] = K.FEATURE_COLUMNS) -> DataFrame:
    """Add ``prediction``, null for rows whose features are not complete; no row is left out."""
    filled = features.withColumns({f"__{c}": F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in columns})
    scored = model.transform(assemble(filled, [f"__{c}" for c in columns])).drop("features", *[f"__{c}" for c in columns])
    return scored.withColumn("prediction", F.when(_complete(columns), F.col("prediction")))


def importances(model: GBTRegressionModel, spark: SparkSession, columns: list[str] = K.FEATURE_COLUMNS) -> DataFrame:
    """Feature importances, largest first."""
    rows = [(c, float(v)) for c, v in zip(columns, model.featureImportances.toArray())]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(
        F.desc("importance"), "feature")


def improvement_pct(baseline, model):
    return F.try_divide(baseline - model, baseline) * 100


def evaluate(model: GBTRegressionModel, split: DataFrame) -> DataFrame:
    """One row: RMSE of the model and of the naive forecast on the test months, and the improvement."""
    test = naive_forecast(predict(model, split.filter(~F.col("is_train"))))
    error, naive_error = (
        F.col("target").cast("double") - F.col(c) for c in ("prediction", "prediction_naive"))
    scores = test.agg(
        F.count(F.lit(1)).alias("test_rows"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.sqrt(F.avg(naive_error * naive_error)).alias("rmse_naive"))
    return scores.withColumn(
        "improvement_pct", improvement_pct(F.col("rmse_naive"), F.col("rmse"))
    ).withColumn("beats_naive", F.col("rmse") < F.col("rmse_naive"))


def naive_score(split: DataFrame) -> DataFrame:
    return rmse(naive_forecast(split.filter(~F.col("is_train"))), "prediction_naive")


def save_model(model: GBTRegressionModel, path: str, report: DataFrame | None = None) -> None:
    """Save the model and, next to it, the metrics table."""
    model.write().overwrite().save(path)
    if report is not None:
        report.write.mode("overwrite").json(f"{path.rstrip('/')}_metrics")


def load_model(path: str) -> GBTRegressionModel:
    return GBTRegressionModel.load(path)
