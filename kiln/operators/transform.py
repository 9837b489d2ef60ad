"""Numeric transforms (T1-T5): z-scores and outlier filter, log1p, skew-driven log,
standard scaling. Statistics are fitted once (one aggregate) and applied as
plain column arithmetic, so ``apply`` also works on streaming DataFrames."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.functions import all_of, numeric, safe_log1p, swish, zscore_expr
from kiln.operators.stats import skew_values


@dataclass(frozen=True)
class FittedZScore:
    """Mean and population std per column (scipy ``zscore`` default ddof=0)."""
    means: dict
    stds: dict

    def expr(self, c: str):
        return zscore_expr(c, self.means[c], self.stds[c])

    def apply(self, df: DataFrame, keep: Sequence[str] = (), suffix: str = "") -> DataFrame:
        """z columns (named ``col + suffix``) next to ``keep`` columns."""
        return df.select(*keep, *[self.expr(c).alias(c + suffix) for c in self.means])


def fit_zscore(df: DataFrame, cols: Sequence[str]) -> FittedZScore:
    row = df.agg(*[F.avg(numeric(c)).alias(f"m{i}") for i, c in enumerate(cols)],
                 *[F.stddev_pop(numeric(c)).alias(f"s{i}") for i, c in enumerate(cols)]).first()
    return FittedZScore({c: row[f"m{i}"] for i, c in enumerate(cols)}, {c: row[f"s{i}"] for i, c in enumerate(cols)})


def zscore_filter(df: DataFrame, cols: Sequence[str], threshold: float = 5.0, two_sided: bool = True,
                  fitted: FittedZScore | None = None) -> DataFrame:
    """Keep rows whose z is below ``threshold`` in every column (|z| when two-sided).
    Statistics ignore NULLs; a row with a NULL z is dropped; zero variance gives z = 0."""
    fz = fitted or fit_zscore(df, cols)
    preds = [(F.abs(fz.expr(c)) if two_sided else fz.expr(c)) < threshold for c in cols]
    return df.filter(all_of(preds))


def log1p_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """ln(1 + x) in place (x <= -1 -> NULL)."""
    return df.withColumns({c: safe_log1p(c) for c in cols})


@dataclass(frozen=True)
class FittedLogSkewed:
    columns: tuple

    def apply(self, df: DataFrame) -> DataFrame:
        return log1p_columns(df, list(self.columns))


def fit_log_skewed(df: DataFrame, cols: Sequence[str], threshold: float = 0.75) -> FittedLogSkewed:
    """Columns whose |G1| exceeds ``threshold`` (fitted on one table, reused on others)."""
    sk = skew_values(df, cols)
    return FittedLogSkewed(tuple(c for c in cols if sk.get(c) is not None and abs(sk[c]) > threshold))


@dataclass(frozen=True)
class FittedScaler:
    """T4: (x - mean) / population std; zero variance -> divide by 1 (as sklearn)."""
    means: dict
    scales: dict

    def apply(self, df: DataFrame) -> DataFrame:
        return df.withColumns({c: (numeric(c) - F.lit(self.means[c])) / F.lit(self.scales[c]) for c in self.means})


def fit_standard_scaler(df: DataFrame, cols: Sequence[str]) -> FittedScaler:
    fz = fit_zscore(df, cols)
    return FittedScaler(dict(fz.means), {c: (s if s else 1.0) for c, s in fz.stds.items()})


def swish_columns(df: DataFrame, cols: Sequence[str], suffix: str = "") -> DataFrame:
    """T5: x / (1 + e^-x)."""
    return df.withColumns({c + suffix: swish(c) for c in cols})
