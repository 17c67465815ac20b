"""Terms, scaling, models and whole plans."""

from dataclasses import replace

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from tagwright.operators import scaling as sc
from tagwright.operators import tfidf as tv
from tagwright.plans import bundle, models as mo, training as tr
from tagwright.plans.presets import PLANS
from tagwright.streaming import score as st
from tagwright.workspace import scratch_path
from tests.conftest import plan_of

SMALL = {
    "rf": lambda: mo.random_forest(6, 4), "et": lambda: mo.extra_trees(6, 4),
    "xgb": lambda: mo.boosting(5, 3, 0.3), "ridge": lambda: mo.ridge(1.0),
}


@pytest.fixture(scope="module")
def xy(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(300, 3)) * [1.0, 5.0, 0.2]
    y = 10 + x @ [2.0, -1.0, 0.0] + rng.normal(size=300)
    rows = [(i, float(t), Vectors.dense(v)) for i, (v, t) in enumerate(zip(x, y))]
    return x, y, spark.createDataFrame(rows, ["sample_id", "label", "features"])


def test_ridge_is_the_closed_form(xy):
    x, y, df = xy
    xc, yc = x - x.mean(0), y - y.mean()
    for alpha in (0.1, 1.0, 50.0):
        want = np.linalg.solve(xc.T @ xc + alpha * np.eye(3), xc.T @ yc)
        model = mo.ridge(alpha).fit(df)
        assert model.coefficients.toArray() == pytest.approx(want, abs=1e-6)
        assert model.intercept == pytest.approx(y.mean() - x.mean(0) @ want, abs=1e-9)


def test_elastic_net_is_coordinate_descent(xy):
    x, y, df = xy
    xc, yc, n, a, r = x - x.mean(0), y - y.mean(), len(y), 0.1, 0.5
    w = np.zeros(3)
    for _ in range(2000):
        for j in range(3):
            rest = yc - xc @ w + xc[:, j] * w[j]
            c = xc[:, j] @ rest / n
            w[j] = np.sign(c) * max(abs(c) - a * r, 0) / (xc[:, j] @ xc[:, j] / n + a * (1 - r))
    assert mo.elastic_net(a, r).fit(df).coefficients.toArray() == pytest.approx(w, abs=1e-6)


def test_trees_repeat_beat_the_mean_and_stay_in_range(xy):
    _, y, df = xy
    for make in (SMALL["rf"], SMALL["et"], SMALL["xgb"]):
        first = [r[0] for r in make().fit(df).transform(df).orderBy("sample_id").select("prediction").collect()]
        again = [r[0] for r in make().fit(df).transform(df).orderBy("sample_id").select("prediction").collect()]
        assert first == again
        assert np.abs(np.array(first) - y).mean() < np.abs(y - y.mean()).mean()
    forest = SMALL["rf"]().fit(df).transform(df).agg(F.min("prediction"), F.max("prediction")).first()
    assert y.min() <= forest[0] and forest[1] <= y.max()


def test_extra_trees_differ_from_each_other(xy):
    model = SMALL["et"]().fit(xy[2])
    assert len({t.toDebugString.split("\n", 1)[1] for t in model.trees}) > 1


def test_importances_sum_to_one(spark, xy):
    model = SMALL["rf"]().fit(xy[2])
    rows = sc.importance_table(xy[2], model, ["a", "b", "c"]).collect()
    assert sum(r["importance"] for r in rows) == pytest.approx(1)
    assert [r["importance"] for r in rows] == sorted((r["importance"] for r in rows), reverse=True)


def test_selector_keeps_the_best(xy):
    assert sorted(sc.fit_selector(xy[2], 2).selectedFeatures) == [0, 1]


# ------------------------------------------------------------------ scaling
def test_zero_spread_columns(spark):
    df = spark.createDataFrame([(float(i), 7.0, 1.0 if i % 10 == 0 else 0.0) for i in range(8)], "a double, b double, c double")
    robust = sc.fit_robust(df, ["a", "b", "c"])
    assert robust["a"] == sc.Scale(3.5, 3.5)
    assert robust["b"] == sc.Scale(7.0, 1.0)
    assert robust["c"].width == 1.0
    assert sc.fit_standard(df, ["b"])["b"] == sc.Scale(7.0, 1.0)
    assert sc.fit_standard(spark.createDataFrame([(1.0,), (2.0,)], "a double"), ["a"])["a"] == sc.Scale(1.5, 0.5)


def test_sparse_scaling_equals_dense_scaling(spark):
    rng = np.random.default_rng(1)
    x = rng.random((101, 6)) * (rng.random((101, 6)) < [0.05, 0.2, 0.3, 0.6, 0.95, 1.0])
    rows = [(i, Vectors.sparse(6, [(j, float(v)) for j, v in enumerate(r) if v])) for i, r in enumerate(x)]
    df = spark.createDataFrame(rows, ["sample_id", "tfidf"])
    scale = sc.fit_robust_vector(df, "tfidf", 6)
    q1, q2, q3 = np.quantile(x, [0.25, 0.5, 0.75], axis=0)
    want = (x - q2) / np.where(q3 == q1, 1, q3 - q1)
    ready, blocks = sc.scale_vector(df, "tfidf", scale)
    got = sc.assemble(ready, blocks, ["sample_id"]).orderBy("sample_id").select(vector_to_array("features")).collect()
    order = [int(n.split("_")[1]) for n in sc.vector_names(scale, "tfidf")]
    assert np.array([r[0] for r in got]) == pytest.approx(want[:, order], abs=1e-12)


# -------------------------------------------------------------------- terms
DOCS = ["Red apple pie", "red apple, green apple", "the and of", "", None, "green tea red tea red", "x y z"]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(list(enumerate(DOCS)), "sample_id long, catalog_content string")


def test_ngrams_and_counts(spark, docs):
    s = tv.TfidfSettings(100, (1, 3), 1, None, False, "ascii")
    terms = tv.with_terms(docs, s, "catalog_content", ["sample_id"])
    got = {r["sample_id"]: r["terms"] for r in terms.collect()}
    assert got[0] == ["red", "apple", "pie", "red apple", "apple pie", "red apple pie"]
    assert got[2] == [] and got[3] == [] and got[4] == ["nan"] and got[6] == []
    counts = {(r["sample_id"], r["term"]): r["tf"] for r in tv.term_counts(terms, "sample_id").collect()}
    assert counts[(5, "red")] == 2 and counts[(5, "tea red")] == 2 and counts[(1, "apple")] == 2
    assert sum(n for (i, _), n in counts.items() if i == 5) == 5 + 4 + 3


@pytest.mark.parametrize("sublinear", [True, False])
def test_vectors_equal_long_form(spark, docs, sublinear):
    s = tv.TfidfSettings(5, (1, 2), 1, None, sublinear, "ascii")
    vocabulary = tv.fit_vocabulary(docs, s)
    assert list(vocabulary.terms) == sorted(vocabulary.terms) and len(vocabulary) == 5
    long = {(r["sample_id"], r["idx"]): r["weight"] for r in tv.tfidf_weights(docs, vocabulary).collect()}
    vectors = tv.tfidf_vectors(docs, vocabulary).collect()
    assert len(vectors) == len(DOCS)
    flat = {(r["sample_id"], int(i)): v for r in vectors for i, v in zip(r["tfidf"].indices, r["tfidf"].values)}
    assert flat == pytest.approx(long)


def test_unfitted_and_contradicting_limits(docs):
    with pytest.raises(tv.NotFittedError):
        tv.tfidf_vectors(docs, None)
    with pytest.raises(ValueError):
        tv.fit_vocabulary(docs, tv.TfidfSettings(5, (1, 1), 6, 0.5, False))


def test_fit_shuffles_once_and_vectors_never(spark, docs):
    s = tv.TfidfSettings(5, (1, 2), 1, None, True, "ascii")
    stats = plan_of(tv.term_statistics(tv.term_counts(tv.with_terms(docs, s, "catalog_content", ["sample_id"]), "sample_id")))
    assert stats.count("Exchange") == 1 and stats.count("regexp_extract_all") == 1
    vectors = plan_of(tv.tfidf_vectors(docs, tv.fit_vocabulary(docs, s)))
    assert "Exchange" not in vectors and vectors.count("regexp_extract_all") == 1


# -------------------------------------------------------------------- plans
@pytest.fixture(scope="module")
def fitted(catalog):
    return tr.train(catalog, "fast", members=SMALL, folds=2)


def test_report_has_every_member(spark, fitted):
    rows = fitted.report(spark).collect()
    assert {r["model"] for r in rows} == set(SMALL) and all(r["fitted"] == 1 and r["mae"] > 0 for r in rows)
    assert len(fitted.features.names) == 21 + len(fitted.features.vocabulary)


def test_prediction_is_one_projection(fitted, catalog):
    plan = plan_of(fitted.predict(catalog))
    assert "Exchange" not in plan and "EvalPython" not in plan
    assert fitted.predict(catalog).where("price < 0.1").count() == 0


def test_predictions_do_not_depend_on_partitions(fitted, catalog):
    one, seven = fitted.predict(catalog.coalesce(1)), fitted.predict(catalog.repartition(7))
    assert one.exceptAll(seven).count() == 0 and one.count() == catalog.count()


def test_saved_plan_predicts_the_same(spark, fitted, catalog):
    path = scratch_path(spark, "bundle")
    bundle.save(spark, fitted, path)
    again = bundle.load(spark, path)
    assert again.features.names == fitted.features.names
    assert again.predict(catalog).exceptAll(fitted.predict(catalog)).count() == 0


def test_changed_and_custom_plans_survive_saving(spark, fitted, catalog):
    changed = replace(fitted.plan, name="mine", weights=[(1, {"ridge": 0.25, "rf": 0.75})], floor=5.0, ceiling=900.0, fixed_weights=True)
    own = tr.FittedPlan(changed, fitted.features, fitted.models, fitted.status, fitted.best_params)
    path = scratch_path(spark, "bundle")
    bundle.save(spark, fitted, path)
    bundle.save(spark, own, path)
    again = bundle.load(spark, path)
    assert again.plan.name == "mine" and again.plan.ceiling == 900.0
    assert again.predict(catalog).exceptAll(own.predict(catalog)).count() == 0
    assert own.predict(catalog).exceptAll(fitted.predict(catalog)).count() > 0


def test_no_member_left_is_an_error(catalog):
    bad = {"bad": lambda: mo.random_forest(3, 3, subset="none")}
    with pytest.raises(ValueError, match="no member"):
        tr.train(catalog, "fast", members=bad, folds=None)
    with pytest.raises(Exception, match="none|subset"):
        tr.train(catalog, "fast", members=bad, folds=None, strict=True)


def test_stream_equals_batch(spark, fitted, catalog):
    inbox, out, mark = (scratch_path(spark, n) for n in ("inbox", "out", "mark"))
    catalog.select("sample_id", "catalog_content", "image_link").write.parquet(inbox)
    st.score_stream(fitted, st.catalog_stream(spark, inbox), out, mark, once=True).awaitTermination()
    assert spark.read.parquet(out).exceptAll(fitted.predict(catalog)).count() == 0


def test_failed_member_is_left_out(spark, xy):
    models, status = tr.fit_members(xy[2], {"ok": SMALL["ridge"], "bad": lambda: mo.random_forest(3, 3, subset="none")}, None)
    assert list(models) == ["ok"] and [s[1] for s in status] == [1, 0] and status[1][4]


def test_fixed_weights_refuse_a_missing_member(catalog):
    fitted = tr.train(catalog, PLANS["base"], members={"ridge": SMALL["ridge"]}, folds=None)
    with pytest.raises(ValueError, match="rf"):
        fitted.predict(catalog)


def test_tuning_keeps_the_best(spark, catalog):
    fitted = tr.train(
        catalog, "compact", members={"xgb": SMALL["xgb"]}, folds=None, tuning={"xgb": {"maxIter": [2, 6]}}
    )
    assert fitted.best_params["xgb"]["maxIter"] in (2, 6)


def test_stack_never_sees_its_fold(xy):
    stack = tr.fit_stack(xy[2], {"ridge": SMALL["ridge"], "rf": SMALL["rf"]}, k=3)
    assert stack.out_of_fold.count() == 300
    x, y, df = xy
    fold = {r["sample_id"]: r["fold"] for r in stack.out_of_fold.collect()}
    got = {r["sample_id"]: r["prediction_ridge"] for r in stack.out_of_fold.collect()}
    for k in range(3):
        seen = df.where(~F.col("sample_id").isin([i for i, f in fold.items() if f == k]))
        want = SMALL["ridge"]().fit(seen).transform(df).select("sample_id", "prediction").collect()
        assert all(r[1] == pytest.approx(got[r[0]]) for r in want if fold[r[0]] == k)
    assert stack.predict(df).count() == 300


def test_empty_training_table_is_refused(catalog):
    with pytest.raises(ValueError, match="empty"):
        tr.train(catalog.limit(0), "fast")
