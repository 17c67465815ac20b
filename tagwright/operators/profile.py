"""Profiles of a catalog: summaries, correlations, histograms, box plots, checks.

One aggregate per profile. Values an aggregate must know beforehand (bounds,
minimum and maximum) are fetched as a handful of numbers and go into the next
plan as literals, where they also reach the file scan as filters.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagwright.functions import text as tx
from tagwright.operators.quantiles import GroupedValues, exact_quantiles
from tagwright.workspace import materialize

QUARTILES = (0.25, 0.5, 0.75)


def _unpivot(row: DataFrame, table: dict[str, dict[str, Column]], label: str) -> DataFrame:
    """One row per entry of ``table`` from a one-row frame of aggregates."""
    structs = [
        F.struct(F.lit(name).alias(label), *[c.alias(n) for n, c in cells.items()])
        for name, cells in table.items()
    ]
    return row.select(F.explode(F.array(*structs)).alias("s")).select("s.*")


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, mean, sample deviation, min, quartiles and max of each column."""
    q = exact_quantiles(df, columns, QUARTILES)
    aggs, table = [], {}
    for c in columns:
        v = F.col(c).cast("double")
        aggs += [
            F.count(v).alias(f"{c}.n"), F.avg(v).alias(f"{c}.mean"),
            F.stddev_samp(v).alias(f"{c}.std"), F.min(v).alias(f"{c}.min"),
            F.max(v).alias(f"{c}.max"),
        ]
        table[c] = {
            "count": F.col(f"`{c}.n`"), "mean": F.col(f"`{c}.mean`"),
            "std": F.col(f"`{c}.std`"), "min": F.col(f"`{c}.min`"),
            "p25": F.lit(q[c][0]).cast("double"), "p50": F.lit(q[c][1]).cast("double"),
            "p75": F.lit(q[c][2]).cast("double"), "max": F.col(f"`{c}.max`"),
        }
    return _unpivot(df.agg(*aggs), table, "column")


def mean_by(df: DataFrame, by: str, value: str = "price", name: str = "mean_price") -> DataFrame:
    return df.groupBy(by).agg(F.avg(value).alias(name)).orderBy(F.desc(name), by)


def value_counts(df: DataFrame, by: str) -> DataFrame:
    return df.groupBy(by).agg(F.count(F.lit(1)).alias("count")).orderBy(F.desc("count"), by)


def with_category(df: DataFrame, text: str = "catalog_content") -> DataFrame:
    low = df.withColumn("_low", F.lower(tx.as_text(F.col(text))))
    return low.withColumn("category", tx.category_label(F.col("_low"))).drop("_low")


def pearson(x: str, y: str) -> Column:
    """Correlation over rows that have both; null, not an error, without spread."""
    a, b = F.col(x).cast("double"), F.col(y).cast("double")
    a, b = F.when(b.isNotNull(), a), F.when(a.isNotNull(), b)
    return F.try_divide(F.covar_pop(a, b), F.stddev_pop(a) * F.stddev_pop(b))


def correlation(df: DataFrame, x: str, y: str) -> DataFrame:
    return df.agg(pearson(x, y).alias("correlation"))


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``left, right, correlation`` for every ordered pair, from one aggregate."""
    pairs = list(combinations(columns, 2))
    row = df.agg(
        *[pearson(a, b).alias(f"{a}~{b}") for a, b in pairs],
        *[pearson(a, a).alias(f"{a}~{a}") for a in columns],
    )
    cells = [(a, b, f"{a}~{b}") for a, b in pairs] + [(b, a, f"{a}~{b}") for a, b in pairs]
    cells += [(a, a, f"{a}~{a}") for a in columns]
    structs = [
        F.struct(
            F.lit(a).alias("left"), F.lit(b).alias("right"), F.col(f"`{v}`").alias("correlation")
        )
        for a, b, v in cells
    ]
    return row.select(F.explode(F.array(*structs)).alias("s")).select("s.*")


def correlations_with(df: DataFrame, target: str, columns: Sequence[str]) -> DataFrame:
    """Correlation of each column with the target, highest first."""
    row = df.agg(*[pearson(c, target).alias(c) for c in columns])
    table = {c: {"correlation": F.col(f"`{c}`")} for c in columns}
    return _unpivot(row, table, "column").orderBy(F.desc("correlation"), "column")


def flag_totals(df: DataFrame, flags: Sequence[str]) -> DataFrame:
    return df.agg(*[F.sum(F.col(f).cast("long")).alias(f) for f in flags])


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    columns = list(columns or df.columns)
    row = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return _unpivot(row, {c: {"nulls": F.col(f"`{c}`")} for c in columns}, "column")


def price_summary(df: DataFrame, price: str = "price") -> DataFrame:
    median = exact_quantiles(df, [price], [0.5])[price][0]
    return df.agg(
        F.min(price).alias("min_price"), F.max(price).alias("max_price"),
        F.avg(price).alias("mean_price"),
    ).withColumn("median_price", F.lit(median).cast("double"))


def negative_count(df: DataFrame, price: str = "price") -> DataFrame:
    return df.agg(F.count_if(F.col(price) < 0).alias("negative_prices"))


def length_summary(df: DataFrame, text: str = "catalog_content") -> DataFrame:
    n = F.length(text)
    return df.agg(
        F.min(n).cast("long").alias("min_length"), F.max(n).cast("long").alias("max_length"),
        F.avg(n).alias("mean_length"),
    )


def valid_link_count(df: DataFrame, link: str = "image_link") -> DataFrame:
    ok = F.coalesce(F.col(link).contains("http"), F.lit(False))
    return df.agg(F.count_if(ok).alias("valid_links"), F.count(F.lit(1)).alias("rows"))


def histogram(df: DataFrame, column: str, bins: int = 30) -> DataFrame:
    """``bin, low, high, rows`` for equal-width bins; the last one is closed."""
    spark = df.sparkSession
    ends = df.agg(F.min(column).cast("double"), F.max(column).cast("double")).first()
    if ends[0] is None:
        return spark.createDataFrame([], "bin long, low double, high double, rows long")
    low, high = ends if ends[0] < ends[1] else (ends[0] - 0.5, ends[1] + 0.5)
    width = (high - low) / bins
    counts = (
        df.where(F.col(column).isNotNull())
        .groupBy(_bin(F.col(column), low, width, bins).alias("bin"))
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    return (
        spark.range(bins).withColumnRenamed("id", "bin").join(counts, "bin", "left")
        .select(
            "bin", (F.lit(low) + F.col("bin") * width).alias("low"),
            (F.lit(low) + (F.col("bin") + 1) * width).alias("high"),
            F.coalesce("rows", F.lit(0)).alias("rows"),
        )
    )


def _bin(c: Column, low: float, width: float, bins: int) -> Column:
    return F.least(F.floor((c.cast("double") - low) / width), F.lit(bins - 1)).cast("long")


def binned_pairs(df: DataFrame, x: str, y: str, bins: int = 50) -> DataFrame:
    """A scatter plot's content as counts on a ``bins`` x ``bins`` grid."""
    ends = df.agg(*[
        f(F.col(c).cast("double")) for c in (x, y) for f in (F.min, F.max)
    ]).first()
    cells = []
    for c, lo, hi in ((x, ends[0], ends[1]), (y, ends[2], ends[3])):
        if lo is None:
            return df.sparkSession.createDataFrame([], "x_bin long, y_bin long, rows long")
        lo, hi = (lo, hi) if lo < hi else (lo - 0.5, hi + 0.5)
        cells.append(_bin(F.col(c), lo, (hi - lo) / bins, bins))
    pairs = df.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    return pairs.groupBy(cells[0].alias("x_bin"), cells[1].alias("y_bin")).agg(
        F.count(F.lit(1)).alias("rows")
    )


def iqr_bounds(df: DataFrame, column: str = "price") -> dict[str, float]:
    """Quartiles and the fences 1.5 interquartile ranges beyond them."""
    q1, q3 = exact_quantiles(df, [column], [0.25, 0.75])[column]
    if q1 is None:
        raise ValueError(f"no values in {column!r}")
    reach = 1.5 * (q3 - q1)
    return {"q1": q1, "q3": q3, "low": q1 - reach, "high": q3 + reach}


def iqr_bounds_table(df: DataFrame, column: str = "price") -> DataFrame:
    return df.sparkSession.createDataFrame(
        [tuple(iqr_bounds(df, column).values())],
        "q1 double, q3 double, low double, high double",
    )


def drop_outliers(
    df: DataFrame, column: str = "price", bounds: dict[str, float] | None = None
) -> DataFrame:
    """Rows inside the fences, both ends included."""
    b = bounds or iqr_bounds(df, column)
    return df.where(F.col(column).between(b["low"], b["high"]))


def outlier_summary(df: DataFrame, column: str = "price") -> DataFrame:
    b = iqr_bounds(df, column)
    inside = F.coalesce(F.col(column).between(b["low"], b["high"]), F.lit(False))
    return df.agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(~inside).alias("removed")
    ).withColumn("removed_percent", F.try_divide(F.col("removed") * 100.0, F.col("rows")))


def box_plot(
    df: DataFrame, column: str = "price", by: str | None = None
) -> DataFrame:
    """Quartiles, whiskers (last data inside the fences) and outlier count.

    With ``by``, one row per group, however large some are: ranges of a group's values that lie on one side of its
    fences are counted as a whole, and only those that cross one are looked into.
    """
    if by is None:
        c = F.col(column).cast("double")
        q1, q2, q3 = (F.lit(v).cast("double") for v in exact_quantiles(df, [column], QUARTILES)[column])
        inside = c.between(q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1))
        return df.agg(
            F.first(q1).alias("q1"), F.first(q2).alias("median"), F.first(q3).alias("q3"),
            F.min(F.when(inside, c)).alias("whisker_low"), F.max(F.when(inside, c)).alias("whisker_high"),
            F.count_if(~inside).alias("outliers"),
        )
    values = GroupedValues(df, column, by)
    q1, q2, q3 = (F.get("quantiles", F.lit(i)) for i in range(3))
    boxes = materialize(values.quantiles(QUARTILES).select(
        "_g", "_by", q1.alias("q1"), q2.alias("median"), q3.alias("q3"),
        (q1 - 1.5 * (q3 - q1)).alias("_from"), (q3 + 1.5 * (q3 - q1)).alias("_to")), "boxes")
    # the ranges of a group's values with the fences of the group: a row per group and part
    ranges = values.parts.select("_g", "_part", "_n", "_low", "_high").where("_n > 0").join(boxes.select("_g", "_from", "_to"), "_g")
    crosses = F.expr("(_low < _from AND _high >= _from) OR (_low <= _to AND _high > _to)")
    rows = values.values_in(ranges.where(crosses)).join(boxes.select("_g", "_from", "_to"), "_g").select(
        "_g", "_n", "_from", "_to", F.col("_v").alias("_low"), F.col("_v").alias("_high"))
    inside = F.expr("_low >= _from AND _high <= _to")
    found = ranges.where(~crosses).drop("_part").unionByName(rows).groupBy("_g").agg(
        F.min(F.when(inside, F.col("_low"))).alias("whisker_low"), F.max(F.when(inside, F.col("_high"))).alias("whisker_high"),
        F.coalesce(F.sum(F.when(~inside, F.col("_n"))), F.lit(0)).alias("outliers"))
    return boxes.join(found, "_g", "left").select(
        F.col("_by").alias(by), "q1", "median", "q3", "whisker_low", "whisker_high",
        F.coalesce("outliers", F.lit(0)).alias("outliers"))


def prediction_summary(predictions: DataFrame, by: str | None = "model") -> DataFrame:
    """count, min, max and mean of the predictions, per model or overall."""
    p = F.col("prediction")
    return predictions.groupBy(*([by] if by else [])).agg(
        F.count(p).alias("predictions"), F.min(p).alias("min_prediction"),
        F.max(p).alias("max_prediction"), F.avg(p).alias("mean_prediction"),
    )
