"""Evaluation metrics (V1-V6) as aggregates over a scored table (label + prediction)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.operators.positions import running_sum
from kiln.operators.quantiles import quantiles


def accuracy(df: DataFrame, y: str, p: str, by: Sequence[str] = ()) -> DataFrame:
    """V1: share of rows with prediction == label."""
    return df.groupBy(*by).agg(F.avg((F.col(y) == F.col(p)).cast("double")).alias("accuracy"))


def r2(df: DataFrame, y: str, p: str, by: Sequence[str] = ()) -> DataFrame:
    """V2: 1 - SS_res / SS_tot (SS_tot = n * population variance of y), one aggregate."""
    d = F.col(y) - F.col(p)
    agg = df.groupBy(*by).agg(F.sum(d * d).alias("_sse"), (F.var_pop(y) * F.count(y)).alias("_sst"))
    return agg.select(*by, (F.lit(1.0) - F.col("_sse") / F.col("_sst")).alias("r2"))


def median_abs_error(df: DataFrame, y: str, p: str, by: Sequence[str] = ()) -> DataFrame:
    """V3: exact median of |y - p| (skew-safe quantile job)."""
    err = df.select(*by, F.abs(F.col(y) - F.col(p)).alias("_e"))
    return quantiles(err, "_e", [0.5], by).select(*by, F.col("value").alias("medae"))


def mse(df: DataFrame, y: str, p: str, by: Sequence[str] = ()) -> DataFrame:
    """V4: mean squared error (per group, e.g. per epoch, when ``by`` is given)."""
    d = F.col(y) - F.col(p)
    return df.groupBy(*by).agg(F.avg(d * d).alias("mse"))


def roc_auc(df: DataFrame, y: str, score: str) -> DataFrame:
    """V5: ROC AUC by the rank-sum rule with ties counted half:
    sum over distinct scores of pos(s) * (neg(< s) + neg(s) / 2) / (P * N).

    Distinct scores are aggregated first (partial aggregation); the running count of
    negatives below each score uses range-partitioned running sums, not one window."""
    per_score = df.groupBy(F.col(score).alias("_s")).agg(
        F.sum(F.col(y).cast("long")).alias("_pos"),
        F.sum((1 - F.col(y)).cast("long")).alias("_neg"))
    cum = running_sum(per_score, ["_s"], "_neg", name="_neg_below", inclusive=False)
    return cum.agg((F.sum(F.col("_pos") * (F.col("_neg_below") + F.col("_neg") / 2.0)) /
                    (F.sum("_pos") * F.sum("_neg"))).alias("auc"))


def confusion_matrix(df: DataFrame, y: str, p: str) -> DataFrame:
    """V6: counts per (actual, predicted) pair, long form."""
    return df.groupBy(F.col(y).alias("actual"), F.col(p).alias("predicted")).agg(F.count(F.lit(1)).alias("n"))
