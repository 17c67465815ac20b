"""Exclusive bundles, shared fits of grids, saved stacks, vocabularies by summaries, hot keys."""

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from tagwright.operators import bundling as bu
from tagwright.operators import tfidf as tv
from tagwright.operators.joins import left_join_unique
from tagwright.operators.profile import box_plot
from tagwright.plans import bundle, models as mo, training as tr
from tagwright.plans.presets import PLANS
from tagwright.workspace import scratch_path

N, D = 400, 14


@pytest.fixture(scope="module")
def sparse(spark):
    """One dense and one negative column, twelve sparse ones in exclusive groups of four, one always zero."""
    rng = np.random.default_rng(0)
    x = np.zeros((N, D))
    x[:, 0] = rng.normal(size=N)
    x[rng.random(N) < 0.2, 1] = -1
    for group in range(3):
        column = rng.integers(0, 6, N)
        for c in range(4):
            x[column == c, 2 + 4 * group + c] = rng.random((column == c).sum()) + 0.1
    x[:, 13] = 0
    y = 3 * x[:, 0] + 10 * (x[:, 3] > 0) + 5 * x[:, 7] + rng.normal(size=N) * 0.1
    rows = [
        (i, float(t), Vectors.sparse(D, [(j, float(a)) for j, a in enumerate(v) if a]) if i % 2 else Vectors.dense(v))
        for i, (v, t) in enumerate(zip(x, y))
    ]
    return x, y, spark.createDataFrame(rows, ["sample_id", "label", "features"]).repartition(3)


def test_co_occurrences(sparse):
    x, _, df = sparse
    present = (x > 0).astype(int)
    assert (bu.co_occurrences(df, "features") == present.T @ present).all()


def test_bundles_are_exclusive_and_lose_nothing(sparse):
    x, _, df = sparse
    b = bu.fit_bundles(df)
    assert b.alone == (0, 1) and sorted(c for g in b.bundles for c in g) == list(range(2, 13))
    assert all(((x[:, list(g)] > 0).sum(1) <= 1).all() for g in b.bundles) and len(b.bundles) == 3
    got = np.array([r[0] for r in b.apply(df).orderBy("sample_id").select(vector_to_array("bundled")).collect()])
    assert (got[:, :2] == x[:, :2]).all()
    for k, g in enumerate(b.bundles):
        want = np.zeros(N)
        for n, c in enumerate(g):
            some = x[:, c] > 0
            want[some] = 1 + 2 * n + (x[some, c] > x[some, c].mean())
        assert (got[:, 2 + k] == want).all()


def test_bundles_hold_as_many_categories_as_bins():
    together = np.diag([5] * 40)
    assert max(map(len, bu.colour(together, list(range(40)), 15))) == 15 and len(bu.colour(together, list(range(40)), 15)) == 3


def test_trees_on_bundles_are_as_good(sparse):
    x, y, df = sparse
    b = bu.fit_bundles(df)
    both = b.apply(df)
    error = {}
    for column in ("features", "bundled"):
        model = mo.random_forest(10, 6).setFeaturesCol(column).fit(both)
        error[column] = model.transform(both).select(F.avg(F.abs(F.col("prediction") - F.col("label")))).first()[0]
    assert error["bundled"] < 1.5 * error["features"] < np.abs(y - y.mean()).mean()
    assert mo.random_forest(2, 3).setFeaturesCol("bundled").fit(both).numFeatures == 5


def test_nothing_to_bundle(spark):
    df = spark.createDataFrame([(i, Vectors.dense([i + 1.0, 2.0])) for i in range(5)], ["sample_id", "features"])
    b = bu.fit_bundles(df)
    assert b.bundles == () and b.apply(df).select(vector_to_array("bundled")).first()[0] == [1.0, 2.0]


def test_boosting_prefixes_equal_their_own_fits(sparse):
    _, _, df = sparse
    full = mo.boosting(6, 3, 0.3).fit(df)
    own = mo.boosting(2, 3, 0.3).fit(df)
    first = tr.first_trees(full, 2)
    assert first.transform(df).select("prediction").collect() == own.transform(df).select("prediction").collect()
    assert len(tr.first_trees(mo.random_forest(5, 2).fit(df), 3).trees) == 3


def test_shared_fits_give_the_grids_errors(sparse):
    """Every point of a boosting's grid, as separate fits score it."""
    _, _, df = sparse
    folded = df.withColumn("fold", (F.col("sample_id") % 3).cast("int")).cache()
    grid = {"maxIter": [1, 3], "maxDepth": [2, 3], "stepSize": [0.3]}
    _, best, shared = tr.tune_trees(mo.boosting(1, 2, 0.3), folded, grid)
    _, own, apart = tr.tune(mo.boosting(1, 2, 0.3), folded, grid)
    key = lambda s: (s["maxIter"], s["maxDepth"])
    assert {key(s): s["mae"] for s in shared} == pytest.approx({key(s): s["mae"] for s in apart}, rel=1e-9) and best == own


def test_plan_with_bundles_survives_saving(spark, catalog):
    members = {"xgb": lambda: mo.boosting(3, 3, 0.3), "ridge": lambda: mo.ridge(1.0)}
    fitted = tr.train(catalog, "fast", members=members, folds=None)
    assert fitted.bundles and fitted.models["xgb"].numFeatures < fitted.models["ridge"].numFeatures
    path = scratch_path(spark, "bundled")
    bundle.save(spark, fitted, path)
    assert bundle.load(spark, path).predict(catalog).exceptAll(fitted.predict(catalog)).count() == 0
    plain = tr.train(catalog, "fast", members=members, folds=None, bundle=False)
    assert plain.bundles is None and plain.models["xgb"].numFeatures == plain.models["ridge"].numFeatures


def test_changed_bundles_are_refused(spark, sparse, tmp_path):
    _, _, df = sparse
    stack = tr.fit_stack(df, {"ridge": lambda: mo.ridge(1.0), "xgb": lambda: mo.boosting(2, 2, 0.3)}, k=3)
    bundle.save_stack(spark, stack, str(tmp_path))
    again = bundle.load_stack(spark, str(tmp_path))
    assert again.predict(df).exceptAll(stack.predict(df)).count() == 0
    assert again.out_of_fold.exceptAll(stack.out_of_fold).count() == 0
    part = next(p for p in tmp_path.glob("v-*/members/ridge/**/part-*") if p.is_file())
    # a local file's own checksum would speak up first
    part.with_name(f".{part.name}.crc").unlink()
    kept = part.read_bytes()
    part.write_bytes(kept + b" ")
    with pytest.raises(bundle.BundleError):
        bundle.load_stack(spark, str(tmp_path))
    part.unlink()
    with pytest.raises(bundle.BundleError):
        bundle.load_stack(spark, str(tmp_path))


# ------------------------------------------------------------ vocabularies
@pytest.mark.parametrize("tracked", [(16,), (64, 4096), (1 << 18,)])
def test_vocabulary_by_summaries_is_the_counted_one(spark, sf_dir, tracked):
    """Whether the summary proves its terms, is tried again, or all terms are counted after all."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").repartition(4)
    for settings in (PLANS["enhanced"].tfidf, tv.TfidfSettings(50, (1, 1), 2, 0.5, True, "ascii")):
        got, want = (tv.fit_vocabulary(docs, settings, text="text", key="doc_id", tracked=t) for t in (tracked, ()))
        assert got == want


def test_a_small_summary_can_prove_frequent_terms(spark):
    """Ten frequent words among many rare ones: shown without counting the rare ones."""
    words = " ".join(f"often{i}" for i in range(10))
    df = spark.range(3000).select(F.col("id").alias("sample_id"), F.concat(F.lit(words + " rare"), F.col("id")).alias("t"))
    s = tv.TfidfSettings(10, (1, 1), 1, None, False, "ascii", ())
    found = tv.frequent_terms(tv.with_terms(df, s, "t", ["sample_id"]), 3000, s, (256,))
    assert found == [(f"often{i}", 3000, 3000) for i in range(10)]
    flat = spark.range(3000).select(F.col("id").alias("sample_id"), F.concat(F.lit("rare"), F.col("id")).alias("t"))
    assert tv.frequent_terms(tv.with_terms(flat, s, "t", ["sample_id"]), 3000, s, (256,)) is None


# ------------------------------------------------------------ hot keys
def _largest_share(df) -> float:
    sizes = [r[0] for r in df.groupBy(F.spark_partition_id()).count().select("count").collect()]
    return max(sizes) / sum(sizes)


def test_equal_rows_of_a_hot_key_are_dealt(spark):
    """200,000 equal rows of one key: no partition holds more than twice its share of 16."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        left = spark.range(220_000).select(F.when(F.col("id") < 200_000, -1).otherwise(F.col("id")).alias("k"))
        right = spark.range(-1, 220_000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
        spark.conf.set("spark.sql.shuffle.partitions", "16")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        joined = left_join_unique(left, right, "k")
        assert joined.where("v = 2 * k").count() == 220_000
        assert _largest_share(joined) < 2.5 / 16
    finally:
        for name in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold"):
            spark.conf.unset(name)
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_box_plot_of_a_hot_group(spark):
    """A hot group of equal values and one of different ones, a group with a single value, one without any."""
    rng = np.random.default_rng(3)
    values = [("same", 5.0)] * 3000 + [("wide", float(v)) for v in rng.standard_t(2, 3000)] + [("one", 1.0), ("none", None), (None, 2.0)]
    df = spark.createDataFrame(values, "g string, x double").repartition(5)
    got = {r["g"]: r for r in box_plot(df, "x", "g").collect()}
    for g in ("same", "wide", "one", None):
        x = np.array([v for k, v in values if k == g])
        q1, q2, q3 = np.quantile(x, [0.25, 0.5, 0.75])
        inside = (x >= q1 - 1.5 * (q3 - q1)) & (x <= q3 + 1.5 * (q3 - q1))
        r = got[g]
        assert [r["q1"], r["median"], r["q3"]] == pytest.approx([q1, q2, q3], rel=1e-12)
        assert (r["whisker_low"], r["whisker_high"], r["outliers"]) == (x[inside].min(), x[inside].max(), (~inside).sum())
    assert got["none"]["q1"] is None and got["none"]["outliers"] == 0
