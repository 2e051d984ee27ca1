"""Demand forecaster: boosted regression trees over the forecast features."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stocktide import schemas
from stocktide.config import HOLDOUT_FRACTION, BoostSpec
from stocktide.operators import boosting
from stocktide.operators.boosting import Boosted
from stocktide.operators.evaluate import forecast_metrics
from stocktide.operators.features import forecast_features, holdout_split, label_encode

INPUTS = schemas.FORECAST_COLUMNS + schemas.FORECAST_CODES


def training_frame(features: DataFrame, chunk_s: int, holdout: float = HOLDOUT_FRACTION) -> DataFrame:
    """Forecast features with store and product codes and the time-based ``is_train`` flag."""
    return holdout_split(label_encode(forecast_features(features, chunk_s)), holdout)


def fit_forecaster(train: DataFrame, spec: BoostSpec = BoostSpec()) -> Boosted:
    """Squared-error boosting with an L2 penalty; one distributed aggregation of histograms a level."""
    return boosting.fit(train, INPUTS, schemas.FORECAST_TARGET, spec)


def predict(model: Boosted, df: DataFrame) -> DataFrame:
    return model.predict(df)


def evaluate(model: Boosted, frame: DataFrame) -> DataFrame:
    """Quality on the holdout rows."""
    return forecast_metrics(predict(model, frame.filter(~F.col("is_train"))), schemas.FORECAST_TARGET, "predicted")


def importances(model: Boosted, spark: SparkSession) -> DataFrame:
    """Importance per input, its share of the gain: as many rows as the model has inputs."""
    return spark.createDataFrame(list(model.importances().items()), "input STRING, importance DOUBLE")
