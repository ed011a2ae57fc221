"""Measures of a frame with ``label`` and ``prediction``, each as one aggregate."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from epitally.functions.expressions import absolute_error


def _metrics() -> list[Column]:
    label, prediction = F.col("label").cast("double"), F.col("prediction")
    error = label - prediction
    both = label.isNotNull() & prediction.isNotNull()
    residual = F.sum(error * error)
    # Spread of the labels as n * var_pop: unlike the difference of two large sums it keeps
    # its digits, and it still needs one pass.
    spread = F.var_pop(F.when(both, label)) * F.count(F.when(both, label))
    return [
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.avg(F.abs(error)).alias("mae"),
        F.when(spread != 0, 1 - residual / F.nullif(spread, F.lit(0.0))).alias("r2"),
    ]


def _target_stats() -> list[Column]:
    return [
        F.avg("label").cast("double").alias("avg_actual"),
        F.avg("prediction").cast("double").alias("avg_predicted"),
        F.min("label").cast("double").alias("min_actual"),
        F.max("label").cast("double").alias("max_actual"),
    ]


def regression_metrics(predictions: DataFrame) -> DataFrame:
    """One row: rmse, mae, r2; nulls for an empty input."""
    return predictions.agg(*_metrics())


def target_stats(predictions: DataFrame) -> DataFrame:
    """One row: mean label and prediction, smallest and largest label."""
    return predictions.agg(*_target_stats())


def evaluate(predictions: DataFrame) -> DataFrame:
    """Metrics and target statistics together, from one scan."""
    return predictions.agg(*_metrics(), *_target_stats())


def error_stats(predictions: DataFrame) -> DataFrame:
    """One row: mean absolute error, smallest and largest prediction, to two digits."""
    return predictions.agg(
        F.round(F.avg(absolute_error()), 2).alias("mean_absolute_error"),
        F.round(F.min("prediction"), 2).alias("min_prediction"),
        F.round(F.max("prediction"), 2).alias("max_prediction"),
    )


def correlation(predictions: DataFrame) -> DataFrame:
    """One row: Pearson correlation of label and prediction."""
    return predictions.agg(F.corr(F.col("label").cast("double"), "prediction").alias("corr"))


def sample_predictions(
    predictions: DataFrame, n: int = 10, order_by: str | None = None
) -> DataFrame:
    """``n`` rows of actual and predicted deaths: the first found, or the first by a column."""
    rows = predictions if order_by is None else predictions.orderBy(order_by)
    return rows.select(
        F.col("label").alias("actual_deaths"), F.col("prediction").alias("predicted_deaths")
    ).limit(n)


def negative_predictions(predictions: DataFrame) -> DataFrame:
    """Rows predicted below zero; a sound model of a count has none."""
    return predictions.where(F.col("prediction") < 0)


def accept_model(metrics: Mapping[str, float | None], rmse_threshold: float = 10_000.0) -> bool:
    """Whether the model may be kept; one without an rmse may not."""
    rmse = metrics.get("rmse")
    return rmse is not None and rmse <= rmse_threshold
