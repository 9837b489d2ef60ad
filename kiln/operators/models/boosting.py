"""AdaBoost (M8 SAMME classifier with stumps, M23 AdaBoost.R2 regressor).

Each round fits one weighted MLlib tree (``weightCol``), measures the weighted
error with one aggregate and updates the weights with a column expression.
The weight table is cut from its lineage with a reliable checkpoint every few
rounds, so a lost executor recomputes at most those rounds.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.operators.models.base import assembler, tree_rows
from kiln.operators.models.linear_algebra import argmax_label
from kiln.session import materialize

CHECKPOINT_EVERY = 5


def _named(model, m: int):
    model = model.setPredictionCol(f"_p{m}")
    for setter in ("setRawPredictionCol", "setProbabilityCol", "setVarianceCol"):
        if hasattr(model, setter):
            getattr(model, setter)("")
    return model


@dataclass
class FittedAdaBoost:
    features: tuple
    stumps: list = field(default_factory=list)   # fitted tree models
    alphas: list = field(default_factory=list)
    classes: list = field(default_factory=list)  # empty for the regressor

    def _with_predictions(self, df: DataFrame) -> DataFrame:
        out = assembler(self.features).transform(df)
        for m, tree in enumerate(self.stumps):
            out = _named(tree, m).transform(out)
        return out.drop("features")

    def transform(self, df: DataFrame, out: str = "prediction") -> DataFrame:
        p = self._with_predictions(df)
        cols = [F.col(f"_p{m}") for m in range(len(self.stumps))]
        if self.classes:  # SAMME vote
            scores = [sum([F.when(c == float(k), F.lit(a)).otherwise(0.0) for c, a in zip(cols, self.alphas)],
                          F.lit(0.0)) for k in self.classes]
            res = p.withColumn(out, argmax_label(scores, [float(k) for k in self.classes]))
        else:  # weighted median of the round predictions
            pairs = F.array_sort(F.array(*[F.struct(c.alias("p"), F.lit(a).alias("w")) for c, a in
                                           zip(cols, self.alphas)]))
            half = 0.5 * sum(self.alphas)
            cum = F.aggregate(pairs, F.struct(F.lit(0.0).alias("s"), F.lit(None).cast("double").alias("v")),
                              lambda acc, x: F.struct((acc["s"] + x["w"]).alias("s"),
                                                      F.when(acc["v"].isNull() & (acc["s"] + x["w"] >= half),
                                                             x["p"]).otherwise(acc["v"]).alias("v")))
            res = p.withColumn(out, cum["v"])
        return res.drop(*[f"_p{m}" for m in range(len(self.stumps))])


def _release(held: list) -> None:
    for df in held:
        df.unpersist()


def _next_weights(data: DataFrame, held: list, m: int) -> tuple[list, float]:
    """The next round's weights, computed, and their sum; earlier rounds' copies are released as soon as they are
    not needed."""
    data = materialize(data) if (m + 1) % CHECKPOINT_EVERY == 0 else data.cache()
    total = data.agg(F.sum("_w")).first()[0]
    _release(held)
    return [data], total


def adaboost_classifier(df: DataFrame, features: Sequence[str], label: str, n_estimators: int = 50,
                        learning_rate: float = 1.0) -> FittedAdaBoost:
    """M8: SAMME with depth-1 trees; alpha = lr * (ln((1 - err) / err) + ln(K - 1))."""
    data = assembler(features).transform(df.select(*features, F.col(label).cast("double").alias("_y")))
    n = data.count()
    classes = sorted(r[0] for r in data.select("_y").distinct().collect())
    k = len(classes)
    data = materialize(tree_rows(data.select("features", "_y", F.lit(1.0 / n).alias("_w")), n_estimators, n))
    fit, held = FittedAdaBoost(tuple(features), classes=classes), []
    for m in range(n_estimators):
        tree = DecisionTreeClassifier(maxDepth=1, labelCol="_y", weightCol="_w", seed=m).fit(data)
        pred = _named(tree, 0).transform(data)
        miss = (F.col("_p0") != F.col("_y")).cast("double")
        err = pred.agg((F.sum(F.col("_w") * miss) / F.sum("_w")).alias("e")).first()["e"]
        if err <= 0:
            fit.stumps.append(tree)
            fit.alphas.append(1.0)
            break
        if err >= 1.0 - 1.0 / k:
            if not fit.stumps:
                fit.stumps.append(tree)
                fit.alphas.append(1.0)
            break
        alpha = learning_rate * (math.log((1 - err) / err) + math.log(k - 1))
        fit.stumps.append(tree)
        fit.alphas.append(alpha)
        total = (1 - err) + err * math.exp(alpha)  # weights sum to 1 before the update
        data = pred.select("features", "_y", (F.col("_w") * F.exp(F.lit(alpha) * miss) / total).alias("_w"))
        held, _ = _next_weights(data, held, m)
        data = held[-1]
    _release(held)
    return fit


def adaboost_regressor(df: DataFrame, features: Sequence[str], label: str, n_estimators: int = 50,
                       learning_rate: float = 1.0, max_depth: int = 3) -> FittedAdaBoost:
    """AdaBoost.R2 with linear loss (weighted fits instead of weighted resampling)."""
    data = assembler(features).transform(df.select(*features, F.col(label).cast("double").alias("_y")))
    n = data.count()
    data = materialize(tree_rows(data.select("features", "_y", F.lit(1.0 / n).alias("_w")), n_estimators, n))
    fit, held = FittedAdaBoost(tuple(features)), []
    for m in range(n_estimators):
        tree = DecisionTreeRegressor(maxDepth=max_depth, labelCol="_y", weightCol="_w", seed=m).fit(data)
        pred = _named(tree, 0).transform(data).withColumn("_e", F.abs(F.col("_p0") - F.col("_y")))
        # One pass: the losses are the errors over the largest.
        emax, wrong, total = pred.agg(F.max("_e"), F.sum(F.col("_w") * F.col("_e")), F.sum("_w")).first()
        if not emax:
            fit.stumps.append(tree)
            fit.alphas.append(1.0)
            break
        loss = F.col("_e") / emax
        avg = wrong / emax / total
        if avg >= 0.5:
            if not fit.stumps:
                fit.stumps.append(tree)
                fit.alphas.append(1.0)
            break
        beta = avg / (1 - avg)
        fit.stumps.append(tree)
        fit.alphas.append(learning_rate * math.log(1 / beta))
        upd = F.col("_w") * F.pow(F.lit(beta), (1 - loss) * learning_rate)
        held, total = _next_weights(pred.select("features", "_y", upd.alias("_w")), held, m)
        data = held[-1].withColumn("_w", F.col("_w") / total)
    _release(held)
    return fit
