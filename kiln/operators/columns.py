"""Projections (P1-P12) and filters / conditional updates."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kiln.functions import all_of, between_expr, col_of, not_equal_keep_null, threshold_flag
from kiln.operators.positions import positions

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


# ---------------------------------------------------------------- projections

def select_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Projection by list (pruned down to the scan)."""
    return df.select(*names)


def columns_of_type(df: DataFrame, kind: str, exclude: Iterable[str] = ()) -> list[str]:
    """Column names of kind 'number' or 'string', schema order."""
    exclude = set(exclude)
    if kind == "number":
        pick = lambda t: isinstance(t, NUMERIC_TYPES)
    elif kind == "string":
        pick = lambda t: isinstance(t, T.StringType)
    else:
        raise ValueError(kind)
    return [f.name for f in df.schema.fields if pick(f.dataType) and f.name not in exclude]


def columns_by_position(df: DataFrame, start: int | None = None, stop: int | None = None) -> list[str]:
    """Positional slice of the column list (negative stop allowed)."""
    return df.columns[start:stop]


def columns_except(df: DataFrame, names: Iterable[str]) -> list[str]:
    """All columns but ``names``, in order."""
    names = set(names)
    return [c for c in df.columns if c not in names]


def drop_columns(df: DataFrame, names: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """P5: drop many columns, except those listed in ``keep``; missing names are ignored."""
    keep = set(keep)
    return df.drop(*[c for c in names if c not in keep])


def rename_columns(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Rename by dict (absent names ignored)."""
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k in df.columns})


def add_literal(df: DataFrame, name: str, value) -> DataFrame:
    """Constant column (e.g. an origin tag)."""
    return df.withColumn(name, F.lit(value))


def derive(df: DataFrame, name: str, expr: Column | str) -> DataFrame:
    """New column from an expression (Column or SQL text)."""
    return df.withColumn(name, F.expr(expr) if isinstance(expr, str) else expr)


def add_threshold_flag(df: DataFrame, c: str, t: float, name: str) -> DataFrame:
    """``c <= t`` flag, NULL -> False."""
    return df.withColumn(name, threshold_flag(c, t))


def cast_all(df: DataFrame, cols: Sequence[str], to: str = "double") -> DataFrame:
    """P10: numeric cast of many columns in one projection (bad text -> NULL via try_cast)."""
    cols = set(cols)
    return df.select(*[(F.col(c).try_cast(to) if c in cols else F.col(c)).alias(c) for c in df.columns])


def assemble_features(df: DataFrame, cols: Sequence[str], out: str = "features",
                      keep: Sequence[str] = ()) -> DataFrame:
    """Feature columns -> one ML vector column (nulls kept as NaN -> 'keep')."""
    from pyspark.ml.feature import VectorAssembler

    va = VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid="keep")
    return va.transform(df.select(*keep, *cols)).select(*keep, out)


def features_array(df: DataFrame, cols: Sequence[str], out: str = "features", keep: Sequence[str] = ()) -> DataFrame:
    """P11 (SQL form): feature columns -> ARRAY<DOUBLE>."""
    return df.select(*keep, F.array(*[F.col(c).cast("double") for c in cols]).alias(out))


def row_id(df: DataFrame, order_by: Sequence, name: str = "row_id") -> DataFrame:
    """Fresh 0..n-1 numbering in ``order_by`` order, without a one-partition window."""
    return positions(df, order_by, name=name)


# ---------------------------------------------------------------- filters

def where_equal(df: DataFrame, c: str, value) -> DataFrame:
    """keep rows equal to ``value`` (NULL rows drop out)."""
    return df.filter(F.col(c) == F.lit(value))


def where_not_equal(df: DataFrame, c: str, value) -> DataFrame:
    """drop rows equal to ``value``; NULL rows are kept (pandas drop-by-mask semantics)."""
    return df.filter(not_equal_keep_null(c, value))


def range_filter(df: DataFrame, bounds: dict[str, tuple]) -> DataFrame:
    """conjunctive ranges ``{col: (lo, hi, closed)}``."""
    preds = [between_expr(c, *b) for c, b in bounds.items()]
    return df.filter(all_of(preds))


def is_in(df: DataFrame, c: str, values: Iterable) -> DataFrame:
    """membership filter (duplicates in ``values`` are harmless)."""
    return df.filter(F.col(c).isin(sorted(set(values), key=repr)))


def drop_nulls(df: DataFrame, cols: str | Sequence[str]) -> DataFrame:
    """keep rows with no NULL in the subset."""
    return df.dropna(how="any", subset=[cols] if isinstance(cols, str) else list(cols))


def filter_all(df: DataFrame, preds: Sequence[Column]) -> DataFrame:
    """rows passing every predicate."""
    return df.filter(all_of(preds))


def update_where(df: DataFrame, cond: Column, c: str, value) -> DataFrame:
    """set ``c`` to ``value`` where ``cond`` is true; NULL condition leaves the row unchanged."""
    v = value if isinstance(value, Column) else F.lit(value)
    return df.withColumn(c, F.when(F.coalesce(cond, F.lit(False)), v).otherwise(col_of(c)))
