"""The price plans: which features, terms, scaler, models and weights go together."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.ml import Estimator

from tagwright.operators.tfidf import TfidfSettings
from tagwright.plans import models as m

MemberFactory = Callable[[], Estimator]
Rules = list[tuple[int, dict[str, float]]]


@dataclass(frozen=True)
class PricePlan:
    name: str
    features: str
    tfidf: TfidfSettings
    members: dict[str, MemberFactory]
    #: (fewest members, weights), strictest first; none fulfilled: equal weights
    weights: Rules
    scaler: str = "robust"
    drop_outliers: bool = True
    floor: float = 0.1
    ceiling: float | None = 10000.0
    #: all weighted models must be there and weights are used as they are
    fixed_weights: bool = False


# --- fixed values: settings and weights of each plan ------------------------
BASE = PricePlan(
    name="base", features="base",
    tfidf=TfidfSettings(1000, (1, 2), 2, None, False, "ascii"),
    members={
        "rf": lambda: m.random_forest(100, 15),
        "xgb": lambda: m.boosting(100, 6, 0.1),
        "gb": lambda: m.boosting(100, 6, 0.1, seed=43),
        "ridge": lambda: m.ridge(1.0),
    },
    weights=[(4, {"rf": 0.3, "xgb": 0.3, "gb": 0.25, "ridge": 0.15})],
    scaler="standard", drop_outliers=False, ceiling=None, fixed_weights=True,
)

FAST = PricePlan(
    name="fast", features="fast",
    tfidf=TfidfSettings(1000, (1, 2), 2, 0.95, False, "ascii"),
    members={
        "rf": lambda: m.random_forest(100, 15),
        "et": lambda: m.extra_trees(80, 20),
        "xgb": lambda: m.boosting(100, 6, 0.1),
        "ridge": lambda: m.ridge(1.0),
    },
    weights=[], ceiling=None,
)

ENHANCED = PricePlan(
    name="enhanced", features="enhanced",
    tfidf=TfidfSettings(1500, (1, 3), 3, 0.95, True, "ascii"),
    members={
        "rf": lambda: m.random_forest(200, 20, min_leaf=2),
        "et": lambda: m.extra_trees(150, 25),
        "xgb": lambda: m.boosting(200, 8, 0.05, 0.8, 0.8),
        "ridge": lambda: m.ridge(1.0),
    },
    weights=[(3, {"rf": 0.35, "et": 0.25, "xgb": 0.25, "ridge": 0.15})],
)

COMPACT = PricePlan(
    name="compact", features="compact",
    tfidf=TfidfSettings(1500, (1, 3), 3, 0.95, True, "word"),
    members={
        "rf": lambda: m.random_forest(200, 20, min_leaf=2),
        "et": lambda: m.extra_trees(150, 25),
        "xgb": lambda: m.boosting(200, 8, 0.05, 0.8, 0.8),
        "lgb": lambda: m.leafwise_boosting(200, 0.05, 0.8, 0.8),
        "ridge": lambda: m.ridge(1.0),
    },
    weights=[
        (4, {"rf": 0.25, "et": 0.2, "xgb": 0.25, "lgb": 0.2, "ridge": 0.1}),
        (3, {"rf": 0.35, "et": 0.25, "xgb": 0.3, "ridge": 0.1}),
    ],
)

ENHANCED_GPU = PricePlan(
    name="enhanced_gpu", features="enhanced_gpu",
    tfidf=TfidfSettings(2000, (1, 3), 3, 0.95, True, "word_dash_dot"),
    members={
        "rf": lambda: m.random_forest(200, 20, min_leaf=2),
        "et": lambda: m.extra_trees(150, 25),
        "xgb": lambda: m.boosting(200, 8, 0.05, 0.8, 0.8),
        "lgb": lambda: m.leafwise_boosting(200, 0.05, 0.8, 0.8),
        "ridge": lambda: m.ridge(1.0),
    },
    weights=[(4, {
        "gpu_rf": 0.2, "rf": 0.2, "et": 0.15, "xgb": 0.2, "lgb": 0.15,
        "gpu_ridge": 0.05, "ridge": 0.05,
    })],
)

ENHANCED_OPT = PricePlan(
    name="enhanced_opt", features="enhanced_opt",
    tfidf=TfidfSettings(2000, (1, 3), 3, 0.95, True, "strict"),
    members={
        "rf": lambda: m.random_forest(200, 20, min_leaf=2, subset="sqrt"),
        "et": lambda: m.extra_trees(150, 25, min_leaf=2),
        "xgb": lambda: m.boosting(200, 8, 0.05, 0.8, 0.8),
        "lgb": lambda: m.leafwise_boosting(200, 0.05, 0.8, 0.8),
        "gb": lambda: m.boosting(150, 8, 0.05, 0.8),
        "en": lambda: m.elastic_net(0.1, 0.5),
    },
    weights=[
        (4, {"rf": 0.25, "et": 0.2, "xgb": 0.25, "lgb": 0.15, "gb": 0.1, "en": 0.05}),
        (3, {"rf": 0.35, "et": 0.25, "xgb": 0.25, "gb": 0.15}),
    ],
)

PLANS = {p.name: p for p in (BASE, FAST, ENHANCED, COMPACT, ENHANCED_GPU, ENHANCED_OPT)}

#: tuning grids; the boosting one also serves the xgb role
FOREST_GRID = {"numTrees": [100, 200], "maxDepth": [15, 20, 25], "minInstancesPerNode": [1, 2]}
BOOSTING_GRID = {"maxIter": [100, 200], "maxDepth": [6, 8, 10], "stepSize": [0.05, 0.1]}
