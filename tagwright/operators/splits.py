"""Hold-outs and folds, defined on keys so that any cluster repeats them."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagwright.operators.quantiles import exact_quantiles
from tagwright.operators.row_index import key_index
from tagwright.operators.rows import draw
from tagwright.workspace import materialize

def _order(key: str, seed: int | None) -> list[Column]:
    """Key order, or with a seed a random order that repeats anywhere."""
    return [F.col(key)] if seed is None else [draw(key, seed), F.col(key)]


def _at_or_after(df: DataFrame, index: DataFrame, places: list[int], key: str, seed: int | None) -> list[Column]:
    """For each place in the order: whether a row stands there or later.

    Only the keys at the places come to the driver; the answer is a comparison
    of the row with them, so rows are neither joined nor moved.
    """
    wanted = sorted({p for p in places if p > 0})
    found = {
        r["row_index"]: r for r in index.where(F.col("row_index").isin(wanted)).select(
            "row_index", *[c.alias(f"o{i}") for i, c in enumerate(_order(key, seed))]
        ).collect()
    } if wanted else {}
    row = F.struct(*[c.alias(f"o{i}") for i, c in enumerate(_order(key, seed))])
    out = []
    for p in places:
        if p <= 0:
            out.append(F.lit(True))
        elif p not in found:
            out.append(F.lit(False))
        else:
            bound = [found[p][f"o{i}"] for i in range(len(_order(key, seed)))]
            out.append(row >= F.struct(*[F.lit(v).alias(f"o{i}") for i, v in enumerate(bound)]))
    return out


def _indexed(df: DataFrame, key: str, seed: int | None) -> tuple[DataFrame, int]:
    index = key_index(df, key, _order(key, seed)[:-1])
    return index, index.count()


def positional_split(df: DataFrame, fraction: float = 0.7, key: str = "sample_id") -> DataFrame:
    """``split`` is train for the first ``int(fraction * rows)`` keys, else test."""
    index, rows = _indexed(df, key, None)
    (late,) = _at_or_after(df, index, [int(fraction * rows)], key, None)
    return df.withColumn("split", F.when(late, "test").otherwise("train"))


def random_split(df: DataFrame, test_size: float = 0.2, key: str = "sample_id", seed: int = 42) -> DataFrame:
    """``split``: exactly ``ceil(test_size * rows)`` test rows, the first in a seeded random order."""
    index, rows = _indexed(df, key, seed)
    (late,) = _at_or_after(df, index, [math.ceil(test_size * rows)], key, seed)
    return df.withColumn("split", F.when(late, "train").otherwise("test"))


def time_split(df: DataFrame, time: str, quantile: float = 0.8) -> DataFrame:
    """Train up to and including the quantile of a time column, test after it."""
    micros = df.select(F.unix_micros(F.col(time).cast("timestamp")).alias("_t"))
    cut = exact_quantiles(micros, ["_t"], [quantile])["_t"][0]
    t = F.unix_micros(F.col(time).cast("timestamp"))
    return df.withColumn("split", F.when(t <= F.lit(cut), "train").otherwise("test"))


def price_bins(df: DataFrame, bins: int = 5, column: str = "price", name: str = "bin") -> DataFrame:
    """Equal-width bins closed on the right; the minimum is in bin 0."""
    low, high = df.agg(F.min(column).cast("double"), F.max(column).cast("double")).first()
    if low is None or low == high:
        place: Column = F.lit((bins - 1) // 2)
    else:
        place = F.greatest(F.lit(0), F.ceil((F.col(column) - low) / ((high - low) / bins)) - 1)
    return df.withColumn(name, F.when(F.col(column).isNotNull(), place).cast("long"))


def stratified_folds(
    df: DataFrame, k: int = 5, bins: int = 5, column: str = "price",
    key: str = "sample_id", seed: int = 42,
) -> DataFrame:
    """Deal the rows of every price bin over ``k`` folds in a seeded order.

    One global index ordered by bin and draw does the dealing: a bin may hold
    nearly all rows, so none is given to a single task.
    """
    binned = price_bins(df, bins, column)
    order = materialize(
        key_index(binned, key, [F.col("bin"), draw(key, seed)])
        .join(binned.select(key, "bin"), key),
        "strata",
    )
    starts = order.groupBy("bin").agg(F.min("row_index").alias("_start"))
    starts = starts.withColumnRenamed("bin", "_bin")
    dealt = order.join(F.broadcast(starts), F.col("bin").eqNullSafe(F.col("_bin")))
    fold = (F.col("row_index") - F.col("_start")) % k
    return df.join(dealt.select(key, "bin", fold.alias("fold")), key)


def _folds(df: DataFrame, k: int, key: str, seed: int | None) -> DataFrame:
    """Runs of an order, sizes differing by one at most, longer ones first."""
    index, rows = _indexed(df, key, seed)
    size, longer = divmod(rows, k)
    starts = [i * size + min(i, longer) for i in range(1, k)]
    later = _at_or_after(df, index, starts, key, seed)
    return df.withColumn("fold", sum((c.cast("int") for c in later), F.lit(0)))


def contiguous_folds(df: DataFrame, k: int = 3, key: str = "sample_id") -> DataFrame:
    """``fold`` by runs in key order."""
    return _folds(df, k, key, None)


def shuffled_folds(df: DataFrame, k: int = 5, key: str = "sample_id", seed: int = 42) -> DataFrame:
    """``fold`` by runs of a seeded random order."""
    return _folds(df, k, key, seed)


def time_blocks(df: DataFrame, time: str, key: str, splits: int = 5) -> DataFrame:
    """``key, block``: which test block a row belongs to in time order.

    Blocks 0..splits-1 are the runs of ``rows // (splits + 1)`` at the end;
    earlier rows have block -1 and are only ever trained on.
    """
    idx = key_index(df, key, [F.col(time)])
    rows = idx.count()
    size = rows // (splits + 1)
    if size == 0:
        raise ValueError(f"{rows} rows are too few for {splits} splits")
    first = rows - splits * size
    block = F.when(F.col("row_index") < first, -1).otherwise(
        F.floor((F.col("row_index") - first) / F.lit(size))
    )
    return idx.select(key, block.cast("int").alias("block"))


def time_split_rows(blocks: DataFrame, key: str, splits: int = 5) -> DataFrame:
    """``key, split, role``: train on all earlier rows, test on the split's block."""
    roles = F.explode(F.sequence(F.greatest(F.col("block"), F.lit(0)), F.lit(splits - 1)))
    return blocks.select(key, "block", roles.alias("split")).select(
        key, "split", F.when(F.col("block") == F.col("split"), "test").otherwise("train").alias("role")
    )
