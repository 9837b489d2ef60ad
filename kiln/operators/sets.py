"""Row and column set operations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def concat_rows(a: DataFrame, b: DataFrame) -> DataFrame:
    """Union all by column name; columns missing on one side become NULL."""
    return a.unionByName(b, allowMissingColumns=True)


def concat_columns(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """R2: label-aligned full outer join of two tables keyed by ``key``."""
    return a.join(b, on=key, how="full_outer")


def split_by_origin(df: DataFrame, origin: str, value) -> DataFrame:
    """Undo a tagged union (filter on the origin tag, tag dropped)."""
    return df.filter(F.col(origin) == F.lit(value)).drop(origin)


def dedup(df: DataFrame, key: str | Sequence[str], order: Sequence[str]) -> DataFrame:
    """First row per key in ``order`` (ties broken by the remaining columns).

    A min(struct) aggregate instead of a row_number window: the map-side partial
    aggregate collapses a hot key (one text copied a million times) before the
    shuffle, so no task ever holds all copies."""
    keys = [key] if isinstance(key, str) else list(key)
    rest = [c for c in df.columns if c not in keys and c not in order]
    picked = df.groupBy(*keys).agg(F.min(F.struct(*order, *rest)).alias("_m"))
    return picked.select(*keys, *[F.col("_m")[c].alias(c) for c in [*order, *rest]]).select(*df.columns)


def intersect_values(a: DataFrame, b: DataFrame, col: str, col_b: str | None = None) -> DataFrame:
    """Distinct values present in both tables."""
    return a.select(F.col(col).alias("value")).intersect(b.select(F.col(col_b or col).alias("value")))


def is_disjoint(a: DataFrame, b: DataFrame, col: str, col_b: str | None = None) -> bool:
    """True when the two value sets share nothing (stops at the first common value)."""
    return intersect_values(a, b, col, col_b).isEmpty()
