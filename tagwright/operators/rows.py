"""Row-level work: first rows, samples, null filling, duplicates, clipping."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagwright.functions import text as tx


def price_table(df: DataFrame) -> DataFrame:
    return df.select("sample_id", "price")


def first_rows(df: DataFrame, n: int, key: str = "sample_id") -> DataFrame:
    """The ``n`` rows with the smallest keys, as a per-partition top-n."""
    return df.orderBy(key).limit(n)


def draw(key: str, seed: int = 42) -> Column:
    """A repeatable pseudo-random text per key."""
    return F.md5(F.concat_ws("|", F.col(key).cast("string"), F.lit(str(seed))))


def draw_number(key: str, seed: int = 42) -> Column:
    """The same draw as an integer in [0, 2^28)."""
    return F.conv(F.substring(draw(key, seed), 1, 7), 16, 10).cast("long")


def sample_rows(df: DataFrame, n: int, key: str = "sample_id", seed: int = 42) -> DataFrame:
    """``n`` random rows; the same seed picks the same rows on any cluster."""
    return df.orderBy(draw(key, seed), key).limit(n)


def fill_text(df: DataFrame, column: str = "catalog_content", null_text: str = "nan") -> DataFrame:
    return df.withColumn(column, tx.as_text(F.col(column), null_text))


def fill_numbers(df: DataFrame, columns: Sequence[str], value: float = 0) -> DataFrame:
    return df.na.fill(value, list(columns))


def keep_first(df: DataFrame, subset: Sequence[str], key: str = "sample_id") -> DataFrame:
    """One row per distinct ``subset``, the one with the smallest key.

    Grouped by a digest, not the text, so the shuffle that finds the keepers
    moves 40 bytes a row after combining on the map side: a text that fills a
    third of the table costs one row per task. Whole rows then meet their keys
    in a semi join on the unique key.
    """
    parts = [
        F.coalesce(F.sha2(F.col(c).cast("string"), 256), F.lit("null")) for c in subset
    ]
    digests = df.select(F.col(key), F.sha2(F.concat_ws("|", *parts), 256).alias("_digest"))
    keepers = digests.groupBy("_digest").agg(F.min(key).alias(key)).select(key)
    return df.join(keepers, key, "left_semi")


def clip(column: Column, low: float = 0.1, high: float | None = 10000.0) -> Column:
    """Into ``[low, high]``; ``high=None`` sets a floor only."""
    bounded = column if high is None else F.least(F.lit(high), column)
    return F.greatest(F.lit(low), bounded)


def parse_numbers(df: DataFrame, column: str, into: str) -> DataFrame:
    """Text to double; what does not parse becomes 0 and is marked ``failed``."""
    parsed = F.col(column).try_cast("double")
    return df.withColumns({
        into: F.coalesce(parsed, F.lit(0.0)),
        "failed": parsed.isNull().cast("long"),
    })


def failure_count(parsed: DataFrame) -> DataFrame:
    return parsed.agg(
        F.count(F.lit(1)).alias("rows"), F.sum("failed").alias("failed")
    )
