"""Linear discriminant analysis (M9): class means and pooled within-class covariance
from Spark aggregates (class moments + centred scatter), a d x d solve on the driver,
scores as fitted linear expressions."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.operators.models.linear_algebra import argmax_label, class_moments, dot_lit, score_argmax, within_scatter
from kiln.session import spread


@dataclass
class FittedLDA:
    classes: list
    coef: np.ndarray       # classes x d
    intercept: np.ndarray  # classes

    def scores(self, vec: str):
        x = F.col(vec).cast("array<double>")
        return [dot_lit(x, self.coef[k]) + F.lit(float(self.intercept[k])) for k in range(len(self.classes))]

    def transform(self, df: DataFrame, vec: str, out: str = "prediction", label_type=None) -> DataFrame:
        """Vectorised scoring per Arrow batch (``scores`` gives the same as expressions)."""
        return score_argmax(spread(df), vec, self.classes, lambda x: x @ self.coef.T + self.intercept[None, :],
                            out, label_type)


def lda(df: DataFrame, vec: str, label: str) -> FittedLDA:
    """Shared covariance S_w / (n - K); score_k(x) = x S^-1 mu_k - mu_k S^-1 mu_k / 2 + ln pi_k."""
    classes, counts, means, _ = class_moments(df, vec, label)
    n, k = counts.sum(), len(classes)
    cov = within_scatter(df, vec, label, classes, means) / max(n - k, 1)
    prec = np.linalg.pinv(cov)
    coef = means @ prec
    intercept = -0.5 * np.einsum("kd,kd->k", coef, means) + np.log(counts / n)
    return FittedLDA(classes, coef, intercept)
