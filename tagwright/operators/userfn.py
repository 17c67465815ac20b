"""Hooks for user code that runs per row or per batch inside tasks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROW = ("sample_id", "catalog_content", "image_link")


def predict_rows(df: DataFrame, predictor: Callable[[int, str, str], float]) -> DataFrame:
    """``sample_id, price`` from a function of one row's id, text and link."""
    @F.pandas_udf("double")
    def price(ids: pd.Series, texts: pd.Series, links: pd.Series) -> pd.Series:
        return pd.Series([float(predictor(*row)) for row in zip(ids, texts, links)])

    return df.select("sample_id", price(*ROW).alias("price"))


def map_rows(df: DataFrame, fn: Callable[[str], dict], column: str, keep: str, schema: str) -> DataFrame:
    """``keep`` and the dict ``fn`` makes of one cell, as columns."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            made = pd.DataFrame([fn(x) for x in batch[column]], index=batch.index)
            yield pd.concat([batch[[keep]], made], axis=1)

    return df.select(keep, column).mapInPandas(run, schema)


def random_prices(df: DataFrame, seed: int = 42) -> DataFrame:
    """Baseline: a price in [5, 500] with two decimals, repeatable per row."""
    from tagwright.operators.rows import draw_number

    share = draw_number("sample_id", seed) / F.lit(float(1 << 28))
    return df.select("sample_id", F.round(5.0 + 495.0 * share, 2).alias("price"))
