"""Robust and standard scaling, feature scores and selection.

TF-IDF blocks stay sparse. A column's quartiles are 0 unless the column is
non-zero in a quarter of the rows, so only such columns are measured; all
others keep centre 0 and scale 1.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.feature import (
    ElementwiseProduct, UnivariateFeatureSelector, VectorAssembler, VectorSlicer,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagwright.operators.profile import _unpivot, pearson
from tagwright.operators.quantiles import exact_quantiles

_COLUMNS_PER_JOB = 100


@dataclass(frozen=True)
class Scale:
    """Centre and width of one column; a width of 0 is replaced by 1."""

    centre: float
    width: float


def fit_robust(df: DataFrame, columns: Sequence[str]) -> dict[str, Scale]:
    """Median and interquartile range of each column."""
    out = {}
    for i in range(0, len(columns), _COLUMNS_PER_JOB):
        part = list(columns[i:i + _COLUMNS_PER_JOB])
        for c, (q1, q2, q3) in exact_quantiles(df, part, [0.25, 0.5, 0.75]).items():
            out[c] = Scale(q2 or 0.0, (q3 - q1) if q1 is not None and q3 != q1 else 1.0)
    return out


def fit_standard(df: DataFrame, columns: Sequence[str]) -> dict[str, Scale]:
    """Mean and population deviation of each column, in one aggregate."""
    row = df.agg(
        *[F.avg(c).alias(f"m{i}") for i, c in enumerate(columns)],
        *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(columns)],
    ).first()
    return {
        c: Scale(row[f"m{i}"] or 0.0, row[f"s{i}"] or 1.0) for i, c in enumerate(columns)
    }


def scaled(name: str, scale: Scale) -> Column:
    return (F.col(name).cast("double") - F.lit(scale.centre)) / F.lit(scale.width)


def apply_scales(df: DataFrame, scales: dict[str, Scale]) -> DataFrame:
    return df.withColumns({c: scaled(c, s) for c, s in scales.items()})


def scale_table(df: DataFrame, scales: dict[str, Scale]) -> DataFrame:
    rows = [(c, float(s.centre), float(s.width)) for c, s in scales.items()]
    return df.sparkSession.createDataFrame(rows, "column string, centre double, width double")


# ---------------------------------------------------------- sparse vectors
@dataclass(frozen=True)
class VectorScale:
    """Scaling of a sparse block.

    ``widths`` divide every slot. Slots in ``centred`` also have a median; they
    leave the block and become columns of their own, so the rest stays sparse.
    """

    size: int
    widths: tuple[float, ...]
    centred: tuple[tuple[int, float], ...] = ()

    @property
    def kept(self) -> list[int]:
        gone = {i for i, _ in self.centred}
        return [i for i in range(self.size) if i not in gone]


def _slots(df: DataFrame, vector: str, slots: Sequence[int], prefix: str) -> DataFrame:
    """Given slots of a vector as double columns ``prefix0, prefix1, ...``."""
    slicer = VectorSlicer(inputCol=vector, outputCol="_slots", indices=list(slots))
    arrays = slicer.transform(df).withColumn("_slots", vector_to_array("_slots"))
    return arrays.withColumns(
        {f"{prefix}{i}": F.get("_slots", F.lit(i)) for i in range(len(slots))}
    ).drop("_slots")


def fit_robust_vector(df: DataFrame, vector: str, size: int) -> VectorScale:
    """Quartiles of the slots that are non-zero often enough to have any."""
    stats = df.select(
        Summarizer.metrics("count", "numNonZeros").summary(F.col(vector)).alias("s")
    ).select("s.count", "s.numNonZeros").first()
    n = stats["count"]
    # zeros needed for the interpolated third quartile to be 0
    zeros_needed = math.ceil(0.75 * (n - 1)) + 1
    dense = [i for i, nz in enumerate(stats["numNonZeros"]) if n - nz < zeros_needed]
    widths, centred = [1.0] * size, []
    for at in range(0, len(dense), _COLUMNS_PER_JOB):
        part = dense[at:at + _COLUMNS_PER_JOB]
        columns = [f"_q{i}" for i in range(len(part))]
        scales = fit_robust(_slots(df.select(vector), vector, part, "_q"), columns)
        for slot, c in zip(part, columns):
            widths[slot] = scales[c].width
            if scales[c].centre:
                centred.append((slot, scales[c].centre))
    return VectorScale(size, tuple(widths), tuple(centred))


def fit_standard_vector(df: DataFrame, vector: str, size: int) -> VectorScale:
    """Population deviations. Slots are not centred, which would fill them up:
    trees and the unpenalised intercept of the linear models absorb a shift."""
    s = df.select(
        Summarizer.metrics("count", "variance").summary(F.col(vector)).alias("s")
    ).select("s.count", "s.variance").first()
    ratio = (s["count"] - 1) / s["count"]
    return VectorScale(size, tuple(math.sqrt(v * ratio) or 1.0 for v in s["variance"]))


def scale_vector(df: DataFrame, vector: str, scale: VectorScale) -> tuple[DataFrame, list[str]]:
    """The block with its slots scaled; returns the columns that now make it up."""
    columns = []
    if scale.centred:
        slots = [i for i, _ in scale.centred]
        df = _slots(df, vector, slots, "_centred")
        columns = [f"_centred{i}" for i in range(len(slots))]
        df = apply_scales(df, {
            c: Scale(centre, scale.widths[slot])
            for c, (slot, centre) in zip(columns, scale.centred)
        })
    kept = scale.kept
    if not kept:
        return df.drop(vector), columns
    stages = [
        VectorSlicer(inputCol=vector, outputCol="_kept", indices=kept),
        ElementwiseProduct(
            scalingVec=Vectors.dense([1.0 / scale.widths[i] for i in kept]),
            inputCol="_kept", outputCol="_block",
        ),
    ]
    out = PipelineModel(stages).transform(df).drop(vector, "_kept")
    return out.withColumnRenamed("_block", vector), [vector, *columns]


def vector_names(scale: VectorScale, prefix: str) -> list[str]:
    """Feature names in the order :func:`scale_vector` puts them."""
    return [f"{prefix}_{i}" for i in scale.kept] + [f"{prefix}_{i}" for i, _ in scale.centred]


def assemble(df: DataFrame, columns: Sequence[str], keep: Sequence[str], output: str = "features") -> DataFrame:
    """One feature vector per row, inputs in the given order."""
    assembler = VectorAssembler(inputCols=list(columns), outputCol=output, handleInvalid="error")
    return assembler.transform(df).select(*keep, output)


# --------------------------------------------------- scores and importance
def f_scores(df: DataFrame, columns: Sequence[str], target: str = "price") -> DataFrame:
    """Univariate regression score ``r^2 / (1 - r^2) * (n - 2)``, highest first."""
    row = df.agg(F.count(target).alias("_n"), *[pearson(c, target).alias(c) for c in columns])

    def score(c: str) -> Column:
        r2 = F.col(f"`{c}`") * F.col(f"`{c}`")
        return F.try_divide(r2 * (F.col("_n") - 2), F.lit(1.0) - r2)

    table = {c: {"score": score(c)} for c in columns}
    return _unpivot(row, table, "column").orderBy(F.desc("score"), "column")


def fit_selector(df: DataFrame, k: int = 1000, features: str = "features", label: str = "label"):
    """The ``k`` features with the highest regression score, as a fitted stage."""
    selector = UnivariateFeatureSelector(
        featuresCol=features, labelCol=label, outputCol="selected", selectionMode="numTopFeatures"
    )
    selector.setFeatureType("continuous").setLabelType("continuous").setSelectionThreshold(k)
    return selector.fit(df)


def importance_table(df: DataFrame, model, names: Sequence[str]) -> DataFrame:
    """Feature importances of a fitted tree model, highest first."""
    rows = [(n, float(v)) for n, v in zip(names, model.featureImportances.toArray())]
    table = df.sparkSession.createDataFrame(rows, "feature string, importance double")
    return table.orderBy(F.desc("importance"), "feature")
