"""Missing data (N1-N8): fills fitted on one table and applied to another, null reports.

Every fit is one aggregate job over the table (partial aggregation on the
executors); fitted objects hold plain numbers so they pickle and print.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kiln.operators.columns import columns_of_type
from kiln.operators.quantiles import column_quantiles


def _is_float(df: DataFrame, c: str) -> bool:
    return isinstance(df.schema[c].dataType, (T.FloatType, T.DoubleType))


def null_expr(df: DataFrame, c: str):
    """NULL, or NaN for float columns (pandas counts both as missing)."""
    x = F.col(c)
    return (x.isNull() | F.isnan(x)) if _is_float(df, c) else x.isNull()


@dataclass(frozen=True)
class FittedFill:
    """Column -> fill value; ``apply`` replaces NULL (and NaN in float columns)."""
    values: dict = field(default_factory=dict)

    def apply(self, df: DataFrame) -> DataFrame:
        out = []
        for c in df.columns:
            if c in self.values and self.values[c] is not None:
                x = F.when(~null_expr(df, c), F.col(c)) if _is_float(df, c) else F.col(c)
                out.append(F.coalesce(x, F.lit(self.values[c])).alias(c))
            else:
                out.append(F.col(c))
        return df.select(*out)


def fill_constant(df: DataFrame, values: dict | None = None, cols: Sequence[str] = (), value=None) -> DataFrame:
    """Per-column constants, or one ``value`` for ``cols``."""
    spec = dict(values or {})
    spec.update({c: value for c in cols})
    return FittedFill(spec).apply(df)


def fit_median(df: DataFrame, cols: Sequence[str]) -> FittedFill:
    """Exact median (mean of the two middle values) of each column, all columns in the same passes."""
    got = {r["column"]: r["value"] for r in column_quantiles(df, cols, [0.5]).collect()}
    return FittedFill({c: got.get(c) for c in cols})


def mode_of(df: DataFrame, c: str):
    """Most frequent non-null value; ties -> smallest value. Counts are a distributed
    group-by; the winner is a min(struct) aggregate (no sort of all values)."""
    counts = df.filter(F.col(c).isNotNull()).groupBy(c).agg(F.count(F.lit(1)).alias("n"))
    row = counts.agg(F.min(F.struct((-F.col("n")).alias("k"), F.col(c).alias("v"))).alias("m")).first()
    return None if row["m"] is None else row["m"]["v"]


def fit_mode(df: DataFrame, cols: Sequence[str]) -> FittedFill:
    """Most frequent value per column (ties -> smallest)."""
    return FittedFill({c: mode_of(df, c) for c in cols})


def fit_mean(df: DataFrame, cols: Sequence[str]) -> FittedFill:
    """Mean per column (NULL/NaN ignored), all in one aggregate."""
    row = df.agg(*[F.avg(F.when(~null_expr(df, c), F.col(c))).alias(c) for c in cols]).first()
    return FittedFill({c: row[c] for c in cols})


@dataclass(frozen=True)
class FittedRegressionFill:
    y: str
    x: str
    slope: float | None
    intercept: float | None
    r2: float | None
    n: int

    def apply(self, df: DataFrame, out: str | None = None) -> DataFrame:
        pred = F.lit(self.intercept) + F.lit(self.slope) * F.col(self.x)
        return df.withColumn(out or self.y, F.coalesce(F.col(self.y), pred))


def fit_regression_fill(df: DataFrame, y: str, x: str) -> FittedRegressionFill:
    """Least squares y ~ x on complete rows (regr_* aggregates ignore incomplete
    pairs); reports R^2 of the fit."""
    r = df.agg(F.regr_slope(F.col(y), F.col(x)).alias("s"), F.regr_intercept(F.col(y), F.col(x)).alias("i"),
               F.regr_r2(F.col(y), F.col(x)).alias("r2"), F.regr_count(F.col(y), F.col(x)).alias("n")).first()
    return FittedRegressionFill(y, x, r["s"], r["i"], r["r2"], int(r["n"]))


def null_counts(df: DataFrame, column_name: str = "column", count_name: str = "nulls") -> DataFrame:
    """NULL (and NaN) count per column as a long table, from one aggregate."""
    cols = df.columns
    wide = df.agg(*[F.sum(null_expr(df, c).cast("long")).alias(f"c{i}") for i, c in enumerate(cols)])
    pairs = [F.struct(F.lit(c).alias(column_name), F.coalesce(F.col(f"c{i}"), F.lit(0)).alias(count_name))
             for i, c in enumerate(cols)]
    return wide.select(F.explode(F.array(*pairs)).alias("p")).select("p.*")


def missing_report(df: DataFrame) -> DataFrame:
    """(feature, total, percentage) for columns with missing values, most missing first."""
    cols = df.columns
    wide = df.agg(F.count(F.lit(1)).alias("_rows"),
                  *[F.sum(null_expr(df, c).cast("long")).alias(f"c{i}") for i, c in enumerate(cols)])
    pairs = [F.struct(F.lit(c).alias("feature"), F.col(f"c{i}").alias("total")) for i, c in enumerate(cols)]
    long = wide.select("_rows", F.explode(F.array(*pairs)).alias("p")).select("_rows", "p.*")
    long = long.withColumn("percentage", F.col("total") / F.col("_rows") * 100.0).drop("_rows")
    return long.filter(F.col("total") > 0).orderBy(F.desc("total"), "feature")


def frame_summary(df: DataFrame, target: str | None = None) -> DataFrame:
    """One row with column kinds, cell and null totals and null columns by kind."""
    cat = columns_of_type(df, "string", exclude=[target] if target else [])
    num = columns_of_type(df, "number", exclude=[target] if target else [])
    cols = df.columns
    wide = df.agg(F.count(F.lit(1)).alias("_rows"),
                  *[F.sum(null_expr(df, c).cast("long")).alias(f"c{i}") for i, c in enumerate(cols)])
    nul = {c: F.coalesce(F.col(f"c{i}"), F.lit(0)) for i, c in enumerate(cols)}
    has = lambda names: sum([F.when(nul[c] > 0, 1).otherwise(0) for c in names], F.lit(0))
    total_nulls = sum(nul.values(), F.lit(0)) if cols else F.lit(0)
    return wide.select(
        F.lit(len(cat)).cast("long").alias("n_categorical"),
        F.lit(len(num)).cast("long").alias("n_numerical"),
        (F.col("_rows") * F.lit(len(cols))).cast("long").alias("total_cells"),
        total_nulls.cast("long").alias("total_nulls"),
        has(cols).cast("long").alias("null_columns"),
        has(cat).cast("long").alias("null_categorical_columns"),
        has(num).cast("long").alias("null_numerical_columns"))
