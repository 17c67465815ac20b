"""Gram matrices, the linear models made from them, and correlations, against numpy."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors

from tagwright.operators import gram as gr
from tagwright.plans import models as mo, training as tr

N, D = 300, 11
SHARE = [0.05, 0.1, 0.2, 0.3, 1, 1, 1, 0.02, 0.9, 0.5, 0]
#: bytes of stripes of four columns
NARROW = 8 * (D + 2) * 4


@pytest.fixture(scope="module")
def data(spark):
    """Columns of any density, one far from 0, one always 0; dense and sparse vectors; rows that take no part."""
    rng = np.random.default_rng(0)
    x = rng.normal(size=(N, D)) * (rng.random((N, D)) < SHARE) + np.array([0, 0, 0, 0, 1e4, -3, 0, 0, 0, 0, 0])
    y = 10 + x @ rng.normal(size=D) + rng.normal(size=N)
    fold = np.arange(N) % 4 - 1
    rows = [
        (i, float(t), Vectors.dense(v) if i % 3 else Vectors.sparse(D, [(j, float(a)) for j, a in enumerate(v) if a]), int(f))
        for i, (v, t, f) in enumerate(zip(x, y, fold))
    ]
    rows += [(N, None, rows[0][2], 0), (N + 1, 1.0, None, 0)]
    return x, y, fold, spark.createDataFrame(rows, ["sample_id", "label", "features", "fold"]).repartition(3)


def _closed(x, y, alpha):
    xc, yc = x - x.mean(0), y - y.mean()
    return np.linalg.solve(xc.T @ xc + alpha * np.eye(x.shape[1]), xc.T @ yc)


@pytest.mark.parametrize("stripe, driver", [(gr.STRIPE_BYTES, gr.DRIVER_BYTES), (NARROW, gr.DRIVER_BYTES), (NARROW, 0)])
def test_ridge_at_any_width(data, stripe, driver):
    """One stripe, several, and a matrix that never reaches the driver."""
    x, y, _, df = data
    m = gr.moments(gr.gram(df, stripe_bytes=stripe, driver_bytes=driver))
    assert m.n == N and m.mean == pytest.approx(x.mean(0), abs=1e-9) and m.label_mean == pytest.approx(y.mean(), abs=1e-9)
    for alpha in (0.1, 50.0):
        assert gr.solve_ridge(m, alpha) == pytest.approx(_closed(x, y, alpha), abs=1e-9)


def test_elastic_net_meets_its_conditions(data):
    """At the optimum every gradient is the penalty's: within it where the coefficient is 0, at it elsewhere."""
    x, y, _, df = data
    near, far = (gr.moments(gr.gram(df, driver_bytes=b)) for b in (gr.DRIVER_BYTES, 0))
    a, r = 0.1, 0.5
    w = gr.solve_elastic_net(near, a, r)
    xc, yc = x - x.mean(0), y - y.mean()
    slope = xc.T @ (yc - xc @ w) / N - a * (1 - r) * w
    assert (np.abs(slope) <= a * r + 1e-8).all() and slope[w != 0] == pytest.approx(np.sign(w[w != 0]) * a * r, abs=1e-8)
    loss = lambda v: ((yc - xc @ v) ** 2).sum() / 2 / N + a * (r * np.abs(v).sum() + (1 - r) / 2 * (v @ v))
    assert loss(gr.solve_elastic_net(far, a, r, tolerance=1e-6, rounds=40)) < loss(w) + 0.5


def test_parts_add_up(data):
    x, y, fold, df = data
    g = gr.gram(df, by="fold", stripe_bytes=NARROW)
    for parts in ((-1,), (0, 2), (-1, 0, 1, 2)):
        some = np.isin(fold, parts)
        m = gr.moments(g.of(*parts))
        assert m.n == some.sum()
        assert gr.solve_ridge(m, 1.0) == pytest.approx(_closed(x[some], y[some], 1.0), abs=1e-8)
    with pytest.raises(ValueError, match="no row"):
        gr.moments(g.of(7))


def test_no_rows(data):
    with pytest.raises(ValueError, match="no row"):
        gr.gram(data[3].where("false"))


def test_correlations(data):
    x, _, _, df = data
    found = gr.vector_correlations(df.where("label IS NOT NULL"), stripe_bytes=NARROW).toPandas()
    got = found.pivot(index="left", columns="right", values="correlation").to_numpy(dtype=float)
    with np.errstate(invalid="ignore"):
        want = np.corrcoef(x.T)
    assert np.isnan(got).sum() == np.isnan(want).sum() == 2 * D - 1
    assert got[:-1, :-1] == pytest.approx(want[:-1, :-1], abs=1e-10)


def test_model_is_saved_as_any_other(data, tmp_path):
    from pyspark.ml import PipelineModel

    df = data[3].where("label IS NOT NULL AND features IS NOT NULL")
    model = mo.elastic_net(0.1, 0.5).fit(df)
    PipelineModel([model]).write().save(str(tmp_path / "m"))
    again = PipelineModel.load(str(tmp_path / "m"))
    assert again.transform(df).select("prediction").collect() == model.transform(df).select("prediction").collect()


def test_expanding_windows_equal_separate_fits(data, spark):
    """Carried sums give the models that fits on each window's rows give; other members are fitted as they are."""
    df = data[3].where("label IS NOT NULL AND features IS NOT NULL")
    blocks = df.selectExpr("sample_id", "CAST(sample_id / 50 AS INT) - 1 AS block")
    members = {"ridge": lambda: mo.ridge(1.0), "rf": lambda: mo.random_forest(3, 3)}
    got = {(r["split"], r["model"]): r["mae"] for r in tr.expanding_scores(df.drop("fold"), blocks, members).collect()}
    assert len(got) == 10
    joined = df.join(blocks, "sample_id")
    for split in (0, 4):
        model = mo.ridge(1.0).fit(joined.where(f"block < {split}"))
        want = model.transform(joined.where(f"block = {split}")).selectExpr("avg(abs(prediction - label))").first()[0]
        assert got[split, "ridge"] == pytest.approx(want, rel=1e-9)
