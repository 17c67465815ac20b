"""A query that names a plan runs the plan: all its members, in their own sizes, with its folds."""

from dataclasses import replace

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors

from checks import model_queries as mq
from tagwright.plans import models as mo, training as tr
from tagwright.plans.presets import PLANS


def test_member_errors_are_those_of_all_members_of_the_plan(spark, tmp_path, monkeypatch):
    words = ["red lamp", "blue chair", "green table", "old clock", "small ring"]
    rows = [(i, f"{words[i % 5]} {words[i % 3]}", "TYPE", f"Brand#{i % 4}", i % 50, 900.0 + i % 20) for i in range(120)]
    spark.createDataFrame(rows, "p_partkey long, p_name string, p_type string, p_brand string, p_size int, p_retailprice double"
                          ).write.parquet(str(tmp_path / "part.parquet"))
    asked = []

    def noted(name):
        def make():
            asked.append(name)
            return mo.ridge(1.0 + len(name))
        return make

    monkeypatch.setitem(PLANS, "compact", replace(PLANS["compact"], members={n: noted(n) for n in PLANS["compact"].members}))
    found = mq.member_errors_compact(spark, str(tmp_path)).collect()
    names = ["rf", "et", "xgb", "lgb", "ridge"]
    assert {r["model"] for r in found} == {f"{n}, {s}" for n in names for s in ("seen", "held out")} and len(found) == 10
    # three folds and all rows
    assert all(asked.count(n) >= 4 for n in names)


@pytest.fixture(scope="module")
def folded(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(90, 2))
    return spark.createDataFrame(
        [(i, float(v @ [2.0, -1.0]), Vectors.dense(v), i % 3) for i, v in enumerate(x)], ["sample_id", "label", "features", "fold"])


def test_fits_side_by_side_give_the_validators_scores(folded):
    members = {"rf": lambda: mo.random_forest(3, 3), "xgb": lambda: mo.boosting(3, 2, 0.3), "ridge": lambda: mo.ridge(1.0)}
    models, status = tr.fit_members(folded, members, 3)
    assert list(models) == list(members)
    for name, fitted, mae, spread, error in status:
        cv = tr.cross_validate(members[name](), folded, 3)
        assert (fitted, error) == (1, None)
        assert mae == pytest.approx(cv.avgMetrics[0], abs=1e-9) and spread == pytest.approx(2 * cv.stdMetrics[0], abs=1e-9)
        same = zip(*([r[0] for r in m.transform(folded).orderBy("sample_id").select("prediction").collect()]
                     for m in (models[name], cv.bestModel)))
        assert all(a == pytest.approx(b, abs=1e-9) for a, b in same)


def test_an_empty_fold_and_a_broken_member_are_reported(folded):
    members = {"ridge": lambda: mo.ridge(1.0), "broken": lambda: mo.random_forest(2, 2, subset="none")}
    models, status = tr.fit_members(folded, members, 3)
    assert list(models) == ["ridge"] and [s[:2] for s in status] == [("ridge", 1), ("broken", 0)]
    models, status = tr.fit_members(folded.where("fold < 2"), members, 3)
    assert not models and "validation data at fold 2 is empty" in status[0][4]
    with pytest.raises(ValueError, match="Fold number"):
        tr.fit_members(folded, {"ridge": members["ridge"]}, 2, strict=True)
