"""Blends of model predictions, from the long table ``key, model, prediction``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tagwright.operators.metrics import mae


class NoModelError(ValueError):
    """There is no prediction to blend."""


def _weight_table(df: DataFrame, weights: dict[str, float]) -> DataFrame:
    rows = [(m, float(w)) for m, w in weights.items()]
    return F.broadcast(df.sparkSession.createDataFrame(rows, "model string, weight double"))


def pick_weights(members: list[str], rules: list[tuple[int, dict[str, float]]]) -> dict[str, float]:
    """Weights for the members that are there.

    ``rules`` are (fewest members, weights), strictest first; with none
    fulfilled all members weigh the same.
    """
    if not members:
        raise NoModelError("no models available for prediction")
    for fewest, weights in rules:
        if len(members) >= fewest:
            return {m: weights[m] for m in members if m in weights}
    return {m: 1.0 / len(members) for m in members}


def weighted_sum(
    predictions: DataFrame, weights: dict[str, float], members: list[str], key: str = "sample_id"
) -> DataFrame:
    """``sum(weight * prediction)``; every weighted model must be a member."""
    missing = [m for m in weights if m not in members]
    if missing:
        raise NoModelError(f"weighted models without predictions: {missing}")
    return (
        predictions.join(_weight_table(predictions, weights), "model")
        .groupBy(key).agg(F.sum(F.col("weight") * F.col("prediction")).alias("prediction"))
    )


def weighted_mean(predictions: DataFrame, weights: dict[str, float], key: str = "sample_id") -> DataFrame:
    """The same over the sum of the weights present; unweighted models drop out."""
    if not weights:
        raise NoModelError("no models available for prediction")
    return (
        predictions.join(_weight_table(predictions, weights), "model")
        .groupBy(key).agg(
            (F.sum(F.col("weight") * F.col("prediction")) / F.sum("weight")).alias("prediction")
        )
    )


def plain_mean(predictions: DataFrame, key: str = "sample_id") -> DataFrame:
    return predictions.groupBy(key).agg(F.avg("prediction").alias("prediction"))


def performance_weights(scored: DataFrame, actual: str = "price") -> DataFrame:
    """``model, mae, weight`` with ``1 / (1 + mae)`` scaled to a sum of 1.

    ``scored`` has one row per model and key; the result one row per model.
    """
    per_model = scored.groupBy("model").agg(
        mae(F.col("prediction"), F.col(actual)).alias("mae")
    ).withColumn("performance", F.lit(1.0) / (1.0 + F.col("mae")))
    if per_model.isEmpty():
        raise NoModelError("no models available for prediction")
    share = F.col("performance") / F.sum("performance").over(Window.partitionBy())
    return per_model.select("model", "mae", share.alias("weight"))


def to_long(wide: DataFrame, members: list[str], keep: Sequence[str] = ("sample_id",)) -> DataFrame:
    """``keep, model, prediction`` from one column ``prediction_<model>`` per model."""
    if not members:
        raise NoModelError("no models available for prediction")
    cells = [
        F.struct(F.lit(m).alias("model"), F.col(f"prediction_{m}").alias("prediction"))
        for m in members
    ]
    return wide.select(*keep, F.explode(F.array(*cells)).alias("c")).select(
        *keep, F.col("c.model").alias("model"), F.col("c.prediction").alias("prediction")
    )
