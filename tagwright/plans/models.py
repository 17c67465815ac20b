"""Regressors with the penalties and defaults the price plans expect."""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator
from pyspark.ml.common import _py2java
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.linalg import Vectors
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasPredictionCol
from pyspark.ml.regression import GBTRegressor, LinearRegressionModel, RandomForestRegressor
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable

from tagwright.operators.gram import Moments, gram, moments, solve_elastic_net, solve_ridge

SEED = 42
#: histogram memory per pass: fewer passes over the data for wide, deep forests
_TREE_MEMORY_MB = 512
#: from this depth on rows remember their nodes: finding them from the root again for every level costs more
_DEEP = 10


def random_forest(
    trees: int, depth: int, min_leaf: int = 1, subset: str = "all", seed: int = SEED
) -> RandomForestRegressor:
    """Bagged trees; Spark's deepest tree has 30 levels."""
    return RandomForestRegressor(
        numTrees=trees, maxDepth=min(depth, 30), minInstancesPerNode=min_leaf,
        featureSubsetStrategy=subset, seed=seed, maxMemoryInMB=_TREE_MEMORY_MB, cacheNodeIds=depth >= _DEEP,
    )


def extra_trees(trees: int, depth: int, min_leaf: int = 1, seed: int = SEED) -> RandomForestRegressor:
    """Trees on all rows that differ by the features drawn per node.

    Spark cannot draw random cut points, so this stands in for extra trees;
    a third of the features per node keeps the trees different.
    """
    return RandomForestRegressor(
        numTrees=trees, maxDepth=min(depth, 30), minInstancesPerNode=min_leaf,
        bootstrap=False, featureSubsetStrategy="onethird", seed=seed,
        maxMemoryInMB=_TREE_MEMORY_MB, cacheNodeIds=depth >= _DEEP,
    )


def boosting(
    rounds: int, depth: int, rate: float, rows: float = 1.0, columns: float = 1.0, seed: int = SEED
) -> GBTRegressor:
    """Boosted trees; ``columns`` is drawn per node."""
    return GBTRegressor(
        maxIter=rounds, maxDepth=depth, stepSize=rate, subsamplingRate=rows,
        featureSubsetStrategy=str(columns) if columns < 1 else "all", seed=seed,
        maxMemoryInMB=_TREE_MEMORY_MB,
    )


def leafwise_boosting(rounds: int, rate: float, rows: float = 1.0, columns: float = 1.0) -> GBTRegressor:
    """Stands in for leaf-wise boosting: 31 leaves are about five levels."""
    return boosting(rounds, 5, rate, rows, columns)


class PenalizedRegression(
    Estimator, HasFeaturesCol, HasLabelCol, HasPredictionCol,
    DefaultParamsReadable, DefaultParamsWritable,
):
    """Linear regression with a penalty as commonly stated, solved exactly.

    Ridge minimises ``|y - Xw|^2 + alpha |w|^2``; with ``l1Ratio`` it is the
    elastic net ``|y - Xw|^2 / 2n + alpha (r |w|_1 + (1 - r)/2 |w|^2)``. The
    intercept is free. The rows are read once, for their Gram matrix
    (``operators/gram.py``); what is fitted is Spark's own linear model.
    """

    alpha = Param(Params._dummy(), "alpha", "penalty", TypeConverters.toFloat)
    l1Ratio = Param(
        Params._dummy(), "l1Ratio", "share of the L1 penalty; negative means ridge",
        TypeConverters.toFloat,
    )

    @keyword_only
    def __init__(self, *, alpha=1.0, l1Ratio=-1.0, featuresCol="features", labelCol="label",
                 predictionCol="prediction"):
        super().__init__()
        self._setDefault(alpha=1.0, l1Ratio=-1.0)
        self._set(**self._input_kwargs)

    def fit_moments(self, m: Moments) -> LinearRegressionModel:
        """The model of moments taken before; one Gram matrix serves every penalty."""
        alpha, ratio = self.getOrDefault(self.alpha), self.getOrDefault(self.l1Ratio)
        w = solve_ridge(m, alpha) if ratio < 0 else solve_elastic_net(m, alpha, ratio)
        sc = m.gram.table.sparkSession.sparkContext
        made = LinearRegressionModel(sc._jvm.org.apache.spark.ml.regression.LinearRegressionModel(
            self.uid, _py2java(sc, Vectors.dense(w)), float(m.label_mean - m.mean @ w)))
        return made.setFeaturesCol(self.getFeaturesCol()).setPredictionCol(self.getPredictionCol())

    def _fit(self, dataset):
        return self.fit_moments(moments(gram(dataset, self.getFeaturesCol(), self.getLabelCol())))


def ridge(alpha: float = 1.0) -> PenalizedRegression:
    return PenalizedRegression(alpha=alpha)


def elastic_net(alpha: float = 0.1, l1_ratio: float = 0.5) -> PenalizedRegression:
    return PenalizedRegression(alpha=alpha, l1Ratio=l1_ratio)


def mae_evaluator() -> RegressionEvaluator:
    return RegressionEvaluator(metricName="mae")
