"""Errors of predictions against known prices, per model, in one aggregate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def mae(p: Column, y: Column) -> Column:
    return F.avg(F.abs(p - y))


def rmse(p: Column, y: Column) -> Column:
    return F.sqrt(F.avg((p - y) * (p - y)))


def smape(p: Column, y: Column) -> Column:
    """Symmetric percentage error; a pair of zeros adds nothing."""
    share = F.try_divide(F.abs(p - y), (F.abs(y) + F.abs(p)) / 2.0)
    return F.avg(F.coalesce(share, F.lit(0.0))) * 100.0


def r2(p: Column, y: Column) -> Column:
    """1 - squared error / spread of the prices; null when prices are constant."""
    return 1.0 - F.try_divide(F.sum((p - y) * (p - y)), F.var_pop(y) * F.count(y))


METRICS = {"mae": mae, "rmse": rmse, "smape": smape, "r2": r2}


def score(
    df: DataFrame, names: tuple[str, ...] = tuple(METRICS), by: str | None = "model",
    prediction: str = "prediction", actual: str = "price",
) -> DataFrame:
    """The named metrics of each model, over rows that have a known price."""
    p, y = F.col(prediction).cast("double"), F.col(actual).cast("double")
    known = df.where(F.col(prediction).isNotNull() & F.col(actual).isNotNull())
    return known.groupBy(*([by] if by else [])).agg(
        *[METRICS[n](p, y).alias(n) for n in names]
    )


def score_against(predictions: DataFrame, actual: DataFrame, key: str = "sample_id", **kw) -> DataFrame:
    """Like :func:`score`, with the prices in a table of their own."""
    return score(predictions.join(actual.select(key, "price"), key), **kw)
