"""Regressors of the log price, with settings under their usual names."""

from __future__ import annotations

import warnings

from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor, LinearRegression, RandomForestRegressor

SEED = 42
HUBER_EPSILON = 1.35
TREES = ("dtree", "rforest", "xtrees", "gboost", "catboost")
ESTIMATORS = ("c-median", "lr", "ridge", "lasso", "enet", "huber", *TREES, "knn")


def _known(params: dict, allowed: dict[str, str]) -> dict:
    """Estimator settings under Spark's names; those without a counterpart are reported."""
    out = {}
    for name, value in params.items():
        if name in allowed:
            out[allowed[name]] = value
        else:
            warnings.warn(f"estimator parameter {name!r} has no counterpart and is not used", stacklevel=3)
    return out


def linear_regression(kind: str, params: dict, n: int, sigma: float, columns: dict) -> LinearRegression:
    """Linear models with the penalties given on the sum-of-squares scale.

    Spark divides the loss by n and scales the L2 part by the deviation of the
    label, so the penalties are converted before fitting.
    """
    alpha = float(params.get("alpha", 0.0001 if kind == "huber" else 1.0))
    ratio = float(params.get("l1_ratio", 0.5))
    common = dict(standardization=False, maxIter=int(params.get("max_iter", 300)), **columns)
    if kind == "lr":
        # full one-hot blocks are collinear; a vanishing penalty picks one of the equal solutions
        return LinearRegression(regParam=1e-9, elasticNetParam=0.0, **common)
    if kind == "ridge":
        return LinearRegression(regParam=alpha * sigma / n, elasticNetParam=0.0, **common)
    if kind == "lasso":
        return LinearRegression(regParam=alpha, elasticNetParam=1.0, **common)
    if kind == "enet":
        total = alpha * ratio + alpha * (1 - ratio) * sigma
        return LinearRegression(regParam=total, elasticNetParam=alpha * ratio / total, **common)
    return LinearRegression(
        loss="huber", epsilon=float(params.get("epsilon", HUBER_EPSILON)), regParam=2 * alpha / n, **common
    )


def tree_estimator(kind: str, params: dict, columns: dict):
    """Tree models; depths are set, since the defaults of other libraries differ or have no bound."""
    names = {"max_depth": "maxDepth", "depth": "maxDepth", "learning_rate": "stepSize", "n_estimators": "maxIter",
             "iterations": "maxIter", "min_samples_leaf": "minInstancesPerNode", "max_bins": "maxBins",
             "subsample": "subsamplingRate"}
    if kind in ("rforest", "xtrees"):
        names["n_estimators"] = "numTrees"
    given = _known(params, names)
    if kind == "dtree":
        return DecisionTreeRegressor(**{"maxDepth": 12, "seed": SEED, **columns, **given})
    if kind in ("rforest", "xtrees"):
        base = {"numTrees": 100, "maxDepth": 12, "seed": SEED, "featureSubsetStrategy": "onethird", **columns}
        return RandomForestRegressor(**{**base, **given})
    depth = 3 if kind == "gboost" else 6
    return GBTRegressor(**{"maxIter": 100, "maxDepth": depth, "stepSize": 0.1, "seed": SEED, **columns, **given})
