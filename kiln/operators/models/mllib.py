"""Models MLlib already provides, configured to the reference's settings
(M1-M3, M7, M10, M11, M15-M19, M22, M24)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import (DecisionTreeClassifier, GBTClassifier, LogisticRegression,
                                       MultilayerPerceptronClassifier, RandomForestClassifier)
from pyspark.ml.regression import (DecisionTreeRegressor, GBTRegressor, LinearRegression,
                                   RandomForestRegressor)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.operators.models.base import FOREST_VISITS, SparkModel, fit_forest_parts, fit_pipeline, tree_rows

MAX_DEPTH = 30  # MLlib's limit; stands for "grow until pure"


def logistic(df: DataFrame, features: Sequence[str], label: str, C: float = 1.0, max_iter: int = 100) -> SparkModel:
    """M1: L2 logistic regression with sklearn's scaling: penalty C * sum(loss) + ||w||^2 / 2
    equals MLlib's mean loss + regParam / 2 ||w||^2 with regParam = 1 / (C n)."""
    n = df.count()
    est = LogisticRegression(labelCol=label, regParam=1.0 / (C * n), elasticNetParam=0.0,
                             standardization=False, maxIter=max_iter)
    return fit_pipeline(df, features, label, est, binary=True)


def random_forest_classifier(df: DataFrame, features: Sequence[str], label: str, n_trees: int = 100,
                             max_features: int | str = 2, max_depth: int | None = None, seed: int = 1,
                             min_instances: int = 1) -> SparkModel:
    """M2: bootstrap forest; ``max_features`` features tried per split."""
    def fit(trees: int, seed: int) -> SparkModel:
        est = RandomForestClassifier(labelCol=label, numTrees=trees, featureSubsetStrategy=str(max_features),
                                     maxDepth=max_depth or MAX_DEPTH, seed=seed, minInstancesPerNode=min_instances)
        return fit_pipeline(data, features, label, est, binary=True)

    rows = df.count()
    data, most = tree_rows(df, n_trees, rows), max(1, FOREST_VISITS // max(rows, 1))
    return fit(n_trees, seed) if n_trees <= most else fit_forest_parts(df.sparkSession, fit, n_trees, most, seed)


def feature_importance(model, spark) -> DataFrame:
    """M3: (feature, importance) sorted by importance, descending."""
    imp = model.importances()
    t = spark.createDataFrame(list(zip(model.features, [float(v) for v in imp])), "feature string, importance double")
    return t.orderBy(F.desc("importance"), "feature")


def decision_tree_classifier(df: DataFrame, features: Sequence[str], label: str, min_split: int = 10,
                             max_depth: int | None = None) -> SparkModel:
    """M7: single tree; a node splits only with >= min_split rows (each child >= min_split / 2)."""
    est = DecisionTreeClassifier(labelCol=label, maxDepth=max_depth or MAX_DEPTH,
                                 minInstancesPerNode=max(1, min_split // 2))
    return fit_pipeline(df, features, label, est, binary=True)


def gbt_classifier(df: DataFrame, features: Sequence[str], label: str, n_estimators: int = 100,
                   max_depth: int = 3, learning_rate: float = 0.1) -> SparkModel:
    """Gradient-boosted trees (logistic loss)."""
    est = GBTClassifier(labelCol=label, maxIter=n_estimators, maxDepth=max_depth, stepSize=learning_rate, seed=1)
    return fit_pipeline(tree_rows(df, n_estimators), features, label, est, binary=True)


def mlp_classifier(df: DataFrame, features: Sequence[str], label: str, hidden: Sequence[int] = (16, 32, 32),
                   n_classes: int = 2, max_iter: int = 200, seed: int = 1) -> SparkModel:
    """Feed-forward classifier (sigmoid hidden layers, softmax output, L-BFGS)."""
    est = MultilayerPerceptronClassifier(labelCol=label, layers=[len(features), *hidden, n_classes],
                                         maxIter=max_iter, seed=seed)
    return fit_pipeline(df, features, label, est, binary=n_classes == 2)


def linear_regression(df: DataFrame, features: Sequence[str], label: str) -> SparkModel:
    """Ordinary least squares with intercept."""
    est = LinearRegression(labelCol=label, regParam=0.0, solver="normal", standardization=False)
    return fit_pipeline(df, features, label, est)


def ridge(df: DataFrame, features: Sequence[str], label: str, alpha: float = 1.0,
          fit_intercept: bool = True) -> SparkModel:
    """Sklearn ridge ||y - Xw||^2 + alpha ||w||^2. MLlib's normal solver works on
    y / std(y) with mean loss, so regParam = alpha * std_pop(y) / n reproduces it."""
    st = df.agg(F.stddev_pop(label).alias("s"), F.count(label).alias("n")).first()
    reg = alpha * (st["s"] or 1.0) / st["n"]
    est = LinearRegression(labelCol=label, regParam=reg, elasticNetParam=0.0, solver="normal",
                           standardization=False, fitIntercept=fit_intercept)
    return fit_pipeline(df, features, label, est)


def lasso(df: DataFrame, features: Sequence[str], label: str, alpha: float = 1.0) -> SparkModel:
    """Sklearn lasso (1/2n)||y - Xw||^2 + alpha ||w||_1."""
    est = LinearRegression(labelCol=label, regParam=alpha, elasticNetParam=1.0, standardization=False,
                           maxIter=1000, tol=1e-6)
    return fit_pipeline(df, features, label, est)


def kernel_ridge(df: DataFrame, features: Sequence[str], label: str, alpha: float = 1.0) -> SparkModel:
    """Kernel ridge with the default linear kernel = ridge in primal form without intercept."""
    return ridge(df, features, label, alpha, fit_intercept=False)


def decision_tree_regressor(df: DataFrame, features: Sequence[str], label: str,
                            max_depth: int | None = None) -> SparkModel:
    """Regression tree (variance impurity)."""
    return fit_pipeline(df, features, label, DecisionTreeRegressor(labelCol=label, maxDepth=max_depth or MAX_DEPTH))


def random_forest_regressor(df: DataFrame, features: Sequence[str], label: str, n_trees: int = 100,
                            max_depth: int | None = None, seed: int = 1) -> SparkModel:
    """Forest of full trees, all features per split (sklearn regressor default)."""
    est = RandomForestRegressor(labelCol=label, numTrees=n_trees, featureSubsetStrategy="all",
                                maxDepth=max_depth or MAX_DEPTH, seed=seed)
    return fit_pipeline(tree_rows(df, n_trees), features, label, est)


def gbt_regressor(df: DataFrame, features: Sequence[str], label: str, n_estimators: int = 500,
                  learning_rate: float = 0.05, max_depth: int = 4, min_split: int = 3,
                  subsample: float = 1.0, feature_fraction: float | str = "all") -> SparkModel:
    """Boosted regression trees (squared loss); no leaf-count cap in MLlib."""
    est = GBTRegressor(labelCol=label, maxIter=n_estimators, stepSize=learning_rate, maxDepth=max_depth,
                       minInstancesPerNode=max(1, min_split // 2), subsamplingRate=subsample,
                       featureSubsetStrategy=str(feature_fraction), seed=1)
    return fit_pipeline(tree_rows(df, n_estimators), features, label, est)
