"""From a catalog to a fitted plan: features, scaling, models, cross-validation."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import partial
from multiprocessing.pool import ThreadPool

import numpy as np
from pyspark import SparkContext
from pyspark.ml import Estimator, Model
from pyspark.ml.regression import GBTRegressionModel, RandomForestRegressionModel
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

from tagwright.operators import scaling as sc
from tagwright.operators.bundling import Bundles, fit_bundles
from tagwright.operators.ensemble import NoModelError, pick_weights, to_long
from tagwright.operators.gram import gram, moments
from tagwright.operators.metrics import score
from tagwright.operators.profile import drop_outliers
from tagwright.operators.rows import clip
from tagwright.operators.splits import contiguous_folds, shuffled_folds
from tagwright.operators.text_features import feature_names, text_features
from tagwright.operators.tfidf import Vocabulary, fit_vocabulary, tfidf_vectors
from tagwright.plans.models import PenalizedRegression, mae_evaluator, ridge
from tagwright.plans.presets import PLANS, MemberFactory, PricePlan
from tagwright.sources.catalog_csv import check_not_empty
from tagwright.workspace import materialize

KEY, TEXT, PRICE = "sample_id", "catalog_content", "price"
#: the column that trees read where sparse columns are bundled
BUNDLED = "bundled"
#: members, folds and grid points fitted at the same time
PARALLEL_FITS = 4


@dataclass
class FittedFeatures:
    """What turns catalog rows into feature vectors: vocabulary and scales."""

    preset: str
    vocabulary: Vocabulary
    dense: dict[str, sc.Scale]
    sparse: sc.VectorScale
    #: an array column of the input to append, and its width
    image: tuple[str, int] | None = None
    #: of the sparse columns, for the models that read them bundled
    bundles: Bundles | None = None

    @property
    def names(self) -> list[str]:
        images = [f"img_{i}" for i in range(self.image[1])] if self.image else []
        return [*self.dense, *sc.vector_names(self.sparse, "tfidf"), *images]

    def vectors(self, df: DataFrame, keep: Sequence[str] = (KEY,)) -> DataFrame:
        """``keep`` and ``features``; a projection, so streams are fine too."""
        return self.scale(raw_features(df, self.preset, self.vocabulary, keep, self.image), keep)

    def scale(self, raw: DataFrame, keep: Sequence[str]) -> DataFrame:
        ready, blocks = sc.scale_vector(sc.apply_scales(raw, self.dense), "tfidf", self.sparse)
        images = ["_image"] if self.image else []
        return sc.assemble(ready, [*self.dense, *blocks, *images], keep)


def raw_features(
    df: DataFrame, preset: str, vocabulary: Vocabulary, keep: Sequence[str] = (KEY,),
    image: tuple[str, int] | None = None,
) -> DataFrame:
    """Dense features and the TF-IDF vector side by side, made from the same row."""
    from pyspark.ml.functions import array_to_vector

    carried = [*keep, *([image[0]] if image else [])]
    carried += [TEXT] if TEXT not in carried else []
    dense = text_features(df, preset, text=TEXT, keep=carried)
    names = feature_names(preset)
    both = tfidf_vectors(dense, vocabulary, text=TEXT, keep=[*carried, *names])
    images = [array_to_vector(F.col(image[0]).cast("array<double>")).alias("_image")] if image else []
    return both.select(*keep, *[F.col(n).cast("double").alias(n) for n in names], "tfidf", *images)


def fit_features(
    df: DataFrame, plan: PricePlan, image: tuple[str, int] | None = None
) -> tuple[FittedFeatures, DataFrame]:
    """Fitted features and the scaled training table ``key, label, features``.

    The vocabulary is fitted on all rows, the scaler on those kept after the
    outlier filter.
    """
    vocabulary = fit_vocabulary(df, plan.tfidf, text=TEXT, key=KEY)
    rows = drop_outliers(df, PRICE) if plan.drop_outliers else df
    raw = materialize(
        raw_features(rows.withColumn("label", F.col(PRICE)), plan.features, vocabulary,
                     [KEY, "label"], image),
        "raw_features",
    )
    names, size = feature_names(plan.features), len(vocabulary)
    if plan.scaler == "robust":
        dense, sparse = sc.fit_robust(raw, names), sc.fit_robust_vector(raw, "tfidf", size)
    else:
        dense, sparse = sc.fit_standard(raw, names), sc.fit_standard_vector(raw, "tfidf", size)
    fitted = FittedFeatures(plan.features, vocabulary, dense, sparse, image)
    return fitted, fitted.scale(raw, [KEY, "label"])


# ------------------------------------------------------------ fit and score
def cross_validate(
    estimator: Estimator, folded: DataFrame, k: int, grid: list[dict] | None = None,
    parallelism: int = PARALLEL_FITS,
):
    """MAE over the ``fold`` column; the best point is refitted on all rows."""
    cv = CrossValidator(
        estimator=estimator, estimatorParamMaps=grid or [{}], evaluator=mae_evaluator(),
        numFolds=k, foldCol="fold", parallelism=parallelism,
    )
    return cv.fit(folded)


def grid_of(estimator: Estimator, values: dict[str, list]) -> list[dict]:
    builder = ParamGridBuilder()
    for name, options in values.items():
        builder = builder.addGrid(estimator.getParam(name), options)
    return builder.build()


def tune(estimator: Estimator, folded: DataFrame, values: dict[str, list], k: int = 3):
    """Best model, its parameters and the MAE of every grid point."""
    grid = grid_of(estimator, values)
    fitted = cross_validate(estimator, folded, k, grid)
    scores = [
        {**{p.name: v for p, v in point.items()}, "mae": float(score)}
        for point, score in zip(grid, fitted.avgMetrics)
    ]
    best = min(scores, key=lambda s: s["mae"])
    return fitted.bestModel, {n: v for n, v in best.items() if n != "mae"}, scores


def _reading(estimator: Estimator, columns: Sequence[str]) -> Estimator:
    """Trees read the bundled column where there is one."""
    if BUNDLED in columns and estimator.hasParam("maxBins") and estimator.getFeaturesCol() == "features":
        return estimator.setFeaturesCol(BUNDLED)
    return estimator


def first_trees(model: Model, count: int) -> Model:
    """The forest or boosting of a fitted one's first ``count`` trees."""
    context, java = SparkContext._active_spark_context, model._java_obj
    ml = context._jvm.org.apache.spark.ml.regression
    trees = context._gateway.new_array(ml.DecisionTreeRegressionModel, count)
    for i, tree in enumerate(java.trees()[:count]):
        trees[i] = tree
    if isinstance(model, GBTRegressionModel):
        weights = context._gateway.new_array(context._jvm.double, count)
        for i, weight in enumerate(model.treeWeights[:count]):
            weights[i] = weight
        made = GBTRegressionModel(ml.GBTRegressionModel(model.uid, trees, weights, model.numFeatures))
    else:
        made = RandomForestRegressionModel(ml.RandomForestRegressionModel(model.uid, trees, model.numFeatures))
    return made.setFeaturesCol(model.getFeaturesCol()).setPredictionCol(model.getPredictionCol())


def tune_trees(estimator: Estimator, folded: DataFrame, values: dict[str, list], k: int = 3):
    """As :func:`tune`, where points that differ in their number of trees share one fit.

    A boosting of n rounds holds those of fewer: its first rounds are what a fit of fewer gives. A forest's first trees
    are a forest of fewer, of other draws than a fit of its own.
    """
    count = "maxIter" if estimator.hasParam("maxIter") else "numTrees"
    sizes = sorted(values.get(count, [estimator.getOrDefault(count)]))
    others = grid_of(estimator, {n: v for n, v in values.items() if n != count})
    found: dict[tuple[int, int], list[float]] = {}
    for i, point in enumerate(others):
        for fold in range(k):
            seen, held = folded.where(F.col("fold") != fold), folded.where(F.col("fold") == fold)
            model = estimator.copy({**point, estimator.getParam(count): sizes[-1]}).fit(seen)
            wide = held.select("label", model.getFeaturesCol())
            for n in sizes:
                some = first_trees(model, n)
                some = some.setPredictionCol(f"prediction_{n}")
                wide = some.transform(wide)
            row = wide.agg(*[F.avg(F.abs(F.col(f"prediction_{n}") - F.col("label"))).alias(str(n)) for n in sizes]).first()
            for n in sizes:
                found.setdefault((i, n), []).append(row[str(n)])
    scores = [
        {**{p.name: v for p, v in others[i].items()}, count: n, "mae": sum(maes) / k} for (i, n), maes in found.items()
    ]
    best = {n: v for n, v in min(scores, key=lambda s: s["mae"]).items() if n != "mae"}
    return estimator.copy({estimator.getParam(n): v for n, v in best.items()}).fit(folded), best, scores


def fit_members(
    train: DataFrame, members: dict[str, MemberFactory], folds: int | None = 3, strict: bool = False
) -> tuple[dict[str, Model], list[tuple]]:
    """Fit every member; one that fails is reported and left out, or raised if ``strict``.

    Status rows: ``model, fitted, mae, mae_spread, error``, where the spread
    is twice the population deviation over the folds. Members and their folds
    are fitted some at a time: deep trees and boosting are many short jobs, which
    wait for each other far more than for cores.
    """
    held = {r["fold"]: r["count"] for r in train.groupBy("fold").count().collect()} if folds else {}

    def fit(name: str, fold: int | None):
        """The model on all rows, or the error on a fold of one that never saw it; what fails is returned."""
        try:
            estimator = _reading(members[name](), train.columns)
            if fold is None:
                return estimator.fit(train)
            for other in held.keys() - set(range(folds)):
                raise ValueError(f"Fold number must be in range [0, {folds}), but got {other}")
            for rows, part in ((sum(n for i, n in held.items() if i != fold), "training"), (held.get(fold, 0), "validation")):
                if not rows:
                    raise ValueError(f"The {part} data at fold {fold} is empty.")
            model = estimator.fit(train.where(F.col("fold") != fold))
            return mae_evaluator().evaluate(model.transform(train.where(F.col("fold") == fold)))
        except Exception as exc:
            return exc

    # fold by fold, so that few deep forests, which hold the most, are fitted at once
    fits = [(name, fold) for fold in [*range(folds or 0), None] for name in members]
    with ThreadPool(PARALLEL_FITS) as pool:
        tasks = [inheritable_thread_target(train.sparkSession)(partial(fit, *one)) for one in fits]
        found = dict(zip(fits, pool.map(lambda task: task(), tasks, chunksize=1)))
    models, status = {}, []
    for name in members:
        results = [found[name, fold] for fold in [*range(folds or 0), None]]
        failed = next((r for r in results if isinstance(r, Exception)), None)
        if failed is not None:
            if strict:
                raise failed
            status.append((name, 0, None, None, f"{type(failed).__name__}: {failed}"))
            continue
        *maes, models[name] = results
        status.append((name, 1, *((float(np.mean(maes)), 2.0 * float(np.std(maes))) if folds else (None, None)), None))
    return models, status


def honest_scores(
    df: DataFrame, plan: PricePlan | str, *, members: dict[str, MemberFactory] | None = None,
    k: int = 3,
) -> DataFrame:
    """``fold, model`` and all metrics with everything fitted inside the folds.

    The usual scores share vocabulary, fences and scales between folds; here
    each fold's are fitted on the other rows only.
    """
    plan = PLANS[plan] if isinstance(plan, str) else plan
    folded = materialize(contiguous_folds(df, k, KEY), "honest")
    scores = []
    for fold in range(k):
        seen, held = folded.where(F.col("fold") != fold), folded.where(F.col("fold") == fold)
        features, table = fit_features(seen.drop("fold"), plan)
        models = {n: make().fit(table) for n, make in (members or plan.members).items()}
        wide = predict_members(models, features.vectors(held, [KEY, PRICE]), [KEY, PRICE])
        scores.append(score(to_long(wide, list(models), [KEY, PRICE])).withColumn("fold", F.lit(fold)))
    out = scores[0]
    for more in scores[1:]:
        out = out.unionByName(more)
    return out


def expanding_scores(
    table: DataFrame, blocks: DataFrame, members: dict[str, MemberFactory], splits: int = 5, key: str = KEY,
) -> DataFrame:
    """``split, model`` and all metrics over expanding windows: trained on all earlier blocks, scored on the next.

    ``table`` has ``key, label, features``; ``blocks`` has ``key, block`` as
    :func:`tagwright.operators.splits.time_blocks` makes them. Linear members read the rows once, for a Gram
    matrix per block: a window's is the sum of the blocks before it. Other members are fitted on each window's rows.
    """
    made = {name: make() for name, make in members.items()}
    rows = materialize(table.join(blocks.select(key, "block"), key), "windows")
    linear = any(isinstance(e, PenalizedRegression) for e in made.values())
    sums = gram(rows, by="block") if linear else None
    out = None
    for split in range(splits):
        seen, held = rows.where(F.col("block") < split), rows.where(F.col("block") == split)
        window = moments(sums.of(*range(-1, split))) if linear else None
        models = {
            name: e.fit_moments(window) if isinstance(e, PenalizedRegression) else e.fit(seen) for name, e in made.items()
        }
        wide = predict_members(models, held, [key, "label"])
        scores = score(to_long(wide, list(models), [key, "label"]), actual="label").withColumn("split", F.lit(split))
        out = scores if out is None else out.unionByName(scores)
    return out


STATUS_SCHEMA = "model string, fitted long, mae double, mae_spread double, error string"


@dataclass
class FittedPlan:
    plan: PricePlan
    features: FittedFeatures
    models: dict[str, Model]
    status: list[tuple] = field(default_factory=list)
    best_params: dict[str, dict] = field(default_factory=dict)

    @property
    def bundles(self) -> Bundles | None:
        return self.features.bundles

    def report(self, spark) -> DataFrame:
        return spark.createDataFrame(self.status, STATUS_SCHEMA)

    def member_predictions(self, df: DataFrame, keep: Sequence[str] = (KEY,)) -> DataFrame:
        """``keep`` and one column ``prediction_<model>`` per member, in one pass."""
        if not self.models:
            raise NoModelError("no models available for prediction")
        vectors = self.features.vectors(df, keep)
        if self.bundles and any(m.getFeaturesCol() == BUNDLED for m in self.models.values()):
            vectors = self.bundles.apply(vectors)
        return predict_members(self.models, vectors, keep)

    def predict(self, df: DataFrame, keep: Sequence[str] = (KEY,)) -> DataFrame:
        """``keep`` and the blended, bounded ``price``."""
        wide = self.member_predictions(df, keep)
        return wide.select(*keep, self._blend().alias(PRICE))

    def _blend(self):
        members = list(self.models)
        weights = pick_weights(members, self.plan.weights)
        if self.plan.fixed_weights:
            wanted = self.plan.weights[0][1]
            missing = [name for name in wanted if name not in self.models]
            if missing:
                raise NoModelError(f"weighted models without predictions: {missing}")
            weights, total = wanted, 1.0
        else:
            total = sum(weights.values())
        mixed = sum(F.col(f"prediction_{name}") * F.lit(w) for name, w in weights.items())
        return clip(mixed / F.lit(total), self.plan.floor, self.plan.ceiling)


def predict_members(models: dict[str, Model], vectors: DataFrame, keep: Sequence[str]) -> DataFrame:
    out = vectors
    for name, model in models.items():
        out = model.copy({model.predictionCol: f"prediction_{name}"}).transform(out)
    return out.select(*keep, *[f"prediction_{name}" for name in models])


def train(
    df: DataFrame, plan: PricePlan | str, *, members: dict[str, MemberFactory] | None = None,
    folds: int | None = 3, image: tuple[str, int] | None = None,
    tuning: dict[str, dict[str, list]] | None = None, tasks: int | None = None, strict: bool = False, bundle: bool = True,
) -> FittedPlan:
    """Fit a plan on a labelled catalog.

    ``members`` replaces the plan's models, ``tuning`` maps members to grids.
    With ``bundle`` trees read sparse columns bundled, a tenth of the features (``operators/bundling.py``).
    ``tasks`` deals the rows over so many tasks first: about as many as cores
    for trees, whose histograms grow with the tasks, and for a table in one
    small file. A member that fails is reported, or raised if ``strict``.
    """
    plan = PLANS[plan] if isinstance(plan, str) else plan
    check_not_empty(training=df)
    if tasks:
        df = df.repartition(tasks, KEY)
    fitted, table = fit_features(df, plan, image)
    if folds or tuning:
        table = contiguous_folds(table, folds or 3, KEY)
    if bundle and any(make().hasParam("maxBins") for make in (members or plan.members).values()):
        fitted.bundles = fit_bundles(table, output=BUNDLED)
        table = fitted.bundles.apply(table)
    if folds or tuning or fitted.bundles:
        table = materialize(table, "training")
    models, status = fit_members(table, members or plan.members, folds, strict)
    if not models:
        raise NoModelError(f"no member could be fitted: {[(s[0], s[4]) for s in status]}")
    best = {}
    for name, grid in (tuning or {}).items():
        if name in models:
            estimator = _reading((members or plan.members)[name](), table.columns)
            search = tune_trees if {"maxIter", "numTrees"} & set(grid) else tune
            models[name], best[name], _ = search(estimator, table, grid, folds or 3)
    return FittedPlan(plan, fitted, models, status, best)


# ------------------------------------------------------------------ stacking
@dataclass
class Stack:
    members: dict[str, Model]
    blender: Model
    #: key, label, fold and one out-of-fold prediction per member
    out_of_fold: DataFrame

    def predict(self, vectors: DataFrame, keep: Sequence[str] = (KEY,)) -> DataFrame:
        wide = predict_members(self.members, vectors, keep)
        inputs = sc.assemble(wide, [f"prediction_{n}" for n in self.members], keep)
        return self.blender.transform(inputs).select(*keep, F.col("prediction").alias(PRICE))


def fit_stack(
    train_table: DataFrame, members: dict[str, MemberFactory], k: int = 5, alpha: float = 0.1
) -> Stack:
    """Ridge on out-of-fold predictions; members are refitted on all rows.

    Every row is predicted by models that never saw it, and the folds' rows
    are written before the blender reads them.
    """
    folded = materialize(shuffled_folds(train_table, k, KEY), "stack")
    parts = []
    for fold in range(k):
        seen = folded.where(F.col("fold") != fold)
        models = {name: make().fit(seen) for name, make in members.items()}
        held = folded.where(F.col("fold") == fold)
        parts.append(predict_members(models, held, [KEY, "label", "fold"]))
    joined = parts[0]
    for part in parts[1:]:
        joined = joined.unionByName(part)
    out_of_fold = materialize(joined, "out_of_fold")
    inputs = sc.assemble(out_of_fold, [f"prediction_{n}" for n in members], [KEY, "label"])
    blender = ridge(alpha).fit(inputs)
    return Stack({n: make().fit(folded) for n, make in members.items()}, blender, out_of_fold)
