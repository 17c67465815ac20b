"""Exact, linearly interpolated quantiles, the same way for tables of any size.

Of whole columns, every order statistic is bracketed by a sketch, the rows
below and at the bracket's ends are counted exactly, and only the values
strictly inside (a few ten-thousandths of the rows, ties at the ends excluded)
are sorted, over all tasks. The counts decide: a bracket that missed its rank is
opened to all values. By group, equal pairs of group and value are counted
first, and the pairs are sorted over all tasks. The number of jobs depends on
neither columns nor groups; nothing but the ungrouped results comes to the
driver, and no task holds a column or a group.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagwright.workspace import materialize

_SKETCH = 10_000
_SLACK = 2.0 / _SKETCH
_POS_BITS = 33  # monotonically_increasing_id keeps the place in its low 33 bits


def exact_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float]) -> dict[str, list[float]]:
    """``{column: [quantile per prob]}``; ``None`` for a column without values."""
    if not columns:
        return {}
    values = {c: F.col(c).cast("double") for c in columns}
    seen = df.agg(
        *[F.count(v).alias(f"n{i}") for i, v in enumerate(values.values())],
        *[_sketch(v, probs).alias(f"b{i}") for i, v in enumerate(values.values())],
    ).first()
    #: (column, prob): value, rows, low and high end
    series = {
        (c, j): (v, seen[f"n{i}"], *seen[f"b{i}"][2 * j:2 * j + 2])
        for i, (c, v) in enumerate(values.items()) if seen[f"n{i}"] for j in range(len(probs))
    }
    if not series:
        return {c: [None] * len(probs) for c in columns}
    counted = df.agg(*[
        F.struct(*_counts(v, F.lit(low), F.lit(high))).alias(f"c{i}")
        for i, (v, _, low, high) in enumerate(series.values())
    ]).first()
    found, wanted, inside = {}, [], []
    for i, (key, (v, n, low, high)) in enumerate(series.items()):
        below, at_low, between, at_high = counted[i]
        ranks = [r - below for r in _ranks(probs[key[1]], n)]
        whole = min(ranks) < 0 or max(ranks) >= at_low + between + at_high
        if whole:
            ranks, at_low, between, low, high = [r + below for r in ranks], 0, n, -math.inf, math.inf
        for k, r in enumerate(ranks):
            if r < at_low:
                found[key, k] = low
            elif r >= at_low + between:
                found[key, k] = high
            else:
                wanted.append((i, r - at_low))
                found[key, k] = (i, r - at_low)
        if any(w[0] == i for w in wanted):
            keep = v.isNotNull() if whole else (v > low) & (v < high)
            inside.append(F.when(keep, F.struct(F.lit(i).alias("series"), v.alias("value"))))
    if wanted:
        some = df.select(F.explode(F.array_compact(F.array(*inside))).alias("s")).select("s.series", "s.value")
        places = df.sparkSession.createDataFrame(sorted(set(wanted)), "series int, place long")
        got = {(r["series"], r["place"]): r["value"] for r in _at_places(some, places).collect()}
        found = {k: got[v] if isinstance(v, tuple) else v for k, v in found.items()}
    out = {}
    for c in columns:
        out[c] = [None] * len(probs)
        for j, p in enumerate(probs):
            if (c, j) in series:
                at = p * (series[c, j][1] - 1)
                low, high = found[(c, j), 0], found[(c, j), 1]
                out[c][j] = low + (high - low) * (at - math.floor(at))
    return out


class GroupedValues:
    """A column's values by group, equal ones counted, in order over all tasks.

    Equal (group, value) pairs are combined before anything is dealt by value, so a hot group of equal values is one
    row and a hot group of different values is spread by range. What follows works on the written ranges: a table of
    them (a row per group and part) tells which hold a rank or cross a bound, and only those are looked into.
    """

    def __init__(self, df: DataFrame, column: str, by: str):
        self.by = by
        group = F.to_json(F.struct(F.col(by).alias("g")))
        rows = df.select(group.alias("_g"), F.col(by).alias("_by"), F.col(column).cast("double").alias("_v"))
        pairs = rows.groupBy("_g", "_v").agg(F.count(F.lit(1)).alias("_n"), F.first("_by").alias("_by"))
        placed = materialize(
            pairs.repartitionByRange("_g", "_v").sortWithinPartitions("_g", "_v")
            .select("_g", "_v", "_n", "_by", F.monotonically_increasing_id().alias("_id")), "pairs",
        )
        self.placed = placed.withColumn("_part", F.shiftrightunsigned("_id", _POS_BITS))
        some = F.col("_v").isNotNull()
        parts = self.placed.groupBy("_g", "_part").agg(
            F.coalesce(F.sum(F.when(some, F.col("_n"))), F.lit(0)).alias("_n"),
            F.min("_v").alias("_low"), F.max("_v").alias("_high"), F.first("_by").alias("_by"))
        # a row per group and part
        before = F.sum("_n").over(Window.partitionBy("_g").orderBy("_part")) - F.col("_n")
        self.parts = materialize(parts.withColumn("_before", before), "parts")
        self.groups = self.parts.groupBy("_g").agg(F.first("_by").alias("_by"), F.sum("_n").alias("_total"))

    def values_in(self, parts: DataFrame) -> DataFrame:
        """The pairs of some ``_g, _part``."""
        return self.placed.where(F.col("_v").isNotNull()).join(parts.select("_g", "_part").distinct(), ["_g", "_part"])

    def quantiles(self, probs: Sequence[float]) -> DataFrame:
        """``_g, _by, quantiles``; null without values."""
        wanted = self.groups.where("_total > 0").select("_g", F.explode(F.array(*[
            F.struct(F.lit(j).alias("j"), F.lit(k).alias("k"), rank.alias("rank"), (at - F.floor(at)).alias("share"))
            for j, p in enumerate(probs) for at in [F.lit(float(p)) * (F.col("_total") - 1)]
            for k, rank in enumerate((F.floor(at).cast("long"), F.ceil(at).cast("long")))
        ])).alias("w")).select("_g", "w.*")
        at = wanted.join(self.parts.select("_g", "_part", "_n", "_before"), "_g").where(
            (F.col("rank") >= F.col("_before")) & (F.col("rank") < F.col("_before") + F.col("_n"))
        ).select("_g", "_part", "j", "k", "share", (F.col("rank") - F.col("_before")).alias("rank"))
        upto = F.sum("_n").over(Window.partitionBy("_g", "_part").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0))
        held = self.values_in(at).select("_g", "_part", "_v", "_n", upto.alias("_upto"))
        found = at.join(held, ["_g", "_part"]).where(
            (F.col("rank") < F.col("_upto")) & (F.col("rank") >= F.col("_upto") - F.col("_n")))
        low, high = (F.max(F.when(F.col("k") == k, F.col("_v"))) for k in (0, 1))
        made = found.groupBy("_g", "j").agg((low + (high - low) * F.first("share")).alias("q")).groupBy("_g").agg(
            F.transform(F.sort_array(F.collect_list(F.struct("j", "q"))), lambda s: s["q"]).alias("quantiles"))
        return self.groups.join(made, "_g", "left").select("_g", "_by", "quantiles")


def group_quantiles(df: DataFrame, column: str, probs: Sequence[float], by: str) -> DataFrame:
    """``by, quantiles`` per group; a null in ``by`` is a group, without values quantiles are null."""
    return GroupedValues(df, column, by).quantiles(probs).select(F.col("_by").alias(by), "quantiles")


def _ranks(p: float, n: int) -> tuple[int, int]:
    at = p * (n - 1)
    return math.floor(at), math.ceil(at)


def _sketch(v: Column, probs: Sequence[float]) -> Column:
    """Two ends around every quantile."""
    ends = [e for p in probs for e in (max(p - _SLACK, 0.0), min(p + _SLACK, 1.0))]
    return F.percentile_approx(v, F.array(*map(F.lit, ends)), F.lit(_SKETCH))


def _counts(v: Column, low: Column, high: Column) -> list[Column]:
    return [
        F.count_if(v < low).alias("below"), F.count_if(v == low).alias("at_low"),
        F.count_if((v > low) & (v < high)).alias("between"), F.count_if((v == high) & (v > low)).alias("at_high"),
    ]


def _at_places(values: DataFrame, wanted: DataFrame) -> DataFrame:
    """``series, place, value``: the values at places of each series in sorted order.

    Values are range-partitioned by series and value and written with their
    place; counts per partition and series turn places in a series into places
    in partitions.
    """
    placed = materialize(
        values.repartitionByRange("series", "value").sortWithinPartitions("series", "value")
        .select("series", "value", F.monotonically_increasing_id().alias("_id")), "inside",
    ).withColumn("part", F.shiftrightunsigned("_id", _POS_BITS))
    runs = placed.groupBy("series", "part").agg(F.min("_id").alias("first"), F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("series").orderBy("part")) - F.col("n")
    runs = runs.withColumn("before", before)
    at = wanted.join(runs, "series").where(
        (F.col("place") >= F.col("before")) & (F.col("place") < F.col("before") + F.col("n"))
    ).select("series", "place", (F.col("first") + F.col("place") - F.col("before")).alias("_id"))
    return at.join(placed.select("_id", "value"), "_id").select("series", "place", "value")
