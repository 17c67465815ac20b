"""Exclusive feature bundling: sparse columns that are never non-zero together share one feature.

Trees keep a histogram per node and feature. TF-IDF columns are zero almost
everywhere, so histograms of a thousand of them are mostly their zero bins.
Columns that no row has together are put into one bundle: a categorical feature
whose categories are "none of these" and, for each of its columns, "present"
and "above the mean of its non-zero values". A tree can still part any of the
columns from the others, since it orders categories by the label.

Which columns meet is a table of co-occurrences, the Gram matrix of the
columns' indicators, whose size is the vocabulary's, not the rows'. Columns are
coloured greedily, the most frequent first, each into the first bundle it meets
nothing of. The fitted transformer is a pipeline of Spark's own stages
(indicators, and one product with a sparse matrix of category numbers), so
scoring stays in the JVM and saving is Spark's.

Bundles are exclusive on the rows they are fitted on. A later row that has two
columns of a bundle gets the sum of their category numbers, which is another
category or an unknown one; trees treat it as such.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.common import _py2java
from pyspark.ml.feature import Binarizer, ElementwiseProduct, PCAModel, VectorAssembler, VectorSlicer
from pyspark.ml.linalg import Matrices, Vectors
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagwright.operators.gram import gram

#: categories of a bundle, which is also the bins of a numeric feature
MAX_BINS = 32
#: a column is bundled if it is non-zero in less than this share of the rows, and never negative
SPARSE_SHARE = 0.5


def co_occurrences(df: DataFrame, vector: str) -> np.ndarray:
    """In how many rows each two columns are both above zero."""
    rows = Binarizer(threshold=0.0, inputCol=vector, outputCol="_present").transform(df.select(vector))
    # indicators as they are, without an origin
    return np.rint(gram(rows, "_present", None, driver_bytes=1 << 62, centred=False).matrix()[2:, 2:]).astype(np.int64)


def colour(together: np.ndarray, columns: list[int], each: int) -> list[list[int]]:
    """Columns in bundles of at most ``each``, none of which meet; frequent columns choose first."""
    bundles: list[list[int]] = []
    #: by bundle, the columns that meet one of its members
    met: list[np.ndarray] = []
    for c in sorted(columns, key=lambda c: (-together[c, c], c)):
        for bundle, against in zip(bundles, met):
            if len(bundle) < each and not against[c]:
                bundle.append(c)
                against |= together[c] > 0
                break
        else:
            bundles.append([c])
            met.append(together[c] > 0)
    return bundles


@dataclass(frozen=True)
class Bundles:
    """``stages`` makes the column ``output``: first the columns left alone, then the bundles."""

    stages: PipelineModel
    output: str
    alone: tuple[int, ...]
    bundles: tuple[tuple[int, ...], ...]
    levels: int

    @property
    def metadata(self) -> dict:
        """Names the bundles as categorical, which Spark's trees read from the column."""
        numeric = [{"idx": i} for i in range(len(self.alone))]
        nominal = [
            {"idx": len(self.alone) + k, "num_vals": 1 + self.levels * len(b)} for k, b in enumerate(self.bundles)
        ]
        return {"ml_attr": {"attrs": {"numeric": numeric, "nominal": nominal}, "num_attrs": len(numeric) + len(nominal)}}

    def apply(self, df: DataFrame) -> DataFrame:
        """``df`` with the bundled column, the steps' own columns dropped."""
        made = self.stages.transform(df).select(*df.columns, self.output)
        return made.withMetadata(self.output, self.metadata)

    def column_of(self, feature: int) -> tuple[int, ...]:
        """The columns behind a feature of the bundled vector."""
        return (self.alone[feature],) if feature < len(self.alone) else self.bundles[feature - len(self.alone)]


def fit_bundles(
    df: DataFrame, vector: str = "features", output: str = "bundled", bins: int = MAX_BINS, levels: int = 2,
) -> Bundles:
    """Bundles of the sparse columns of a vector; ``levels`` 1 keeps presence only."""
    stats = df.select(
        Summarizer.metrics("count", "numNonZeros", "mean", "min").summary(F.col(vector)).alias("s")).select("s.*").first()
    n, some, mean, low = stats["count"], stats["numNonZeros"].toArray(), stats["mean"].toArray(), stats["min"].toArray()
    sparse = np.flatnonzero((some < SPARSE_SHARE * n) & (low >= 0) & (some > 0)).tolist()
    # a column that is always zero tells nothing
    alone = np.flatnonzero(~((some < SPARSE_SHARE * n) & (low >= 0))).tolist()
    parts: list[Transformer] = []
    inputs = []
    if alone:
        parts.append(VectorSlicer(inputCol=vector, outputCol="_alone", indices=alone))
        inputs.append("_alone")
    groups: list[list[int]] = []
    if sparse:
        parts.append(VectorSlicer(inputCol=vector, outputCol="_sparse", indices=sparse))
        sliced = parts[-1].transform(df.select(vector))
        groups = colour(co_occurrences(sliced, "_sparse"), list(range(len(sparse))), (bins - 1) // levels)
        cut = mean[sparse] * n / some[sparse]
        number = np.zeros((levels * len(sparse), len(groups)))
        for g, members in enumerate(groups):
            for k, c in enumerate(members):
                number[c, g] = 1 + levels * k
                if levels > 1:
                    number[len(sparse) + c, g] = 1
        parts.append(Binarizer(threshold=0.0, inputCol="_sparse", outputCol="_present"))
        marks = ["_present"]
        if levels > 1:
            parts += [
                ElementwiseProduct(scalingVec=Vectors.dense(1 / cut), inputCol="_sparse", outputCol="_share"),
                Binarizer(threshold=1.0, inputCol="_share", outputCol="_above"),
            ]
            marks.append("_above")
        sc = df.sparkSession.sparkContext
        product = PCAModel(sc._jvm.org.apache.spark.ml.feature.PCAModel(
            "bundles", _py2java(sc, Matrices.dense(*number.shape, number.reshape(-1, order="F").tolist())),
            _py2java(sc, Vectors.dense(np.zeros(len(groups)))),
        )).setInputCol("_marks").setOutputCol("_bundles")
        product._set(k=len(groups))
        parts += [VectorAssembler(inputCols=marks, outputCol="_marks"), product]
        inputs.append("_bundles")
    parts.append(VectorAssembler(inputCols=inputs, outputCol=output))
    return Bundles(
        PipelineModel(parts), output, tuple(alone), tuple(tuple(sparse[c] for c in g) for g in groups), levels)
