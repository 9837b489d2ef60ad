"""Recoding and binning (E1-E8, E15): value maps, prefix rules, right-closed cuts,
rule bins, mean-fitted bins, presence / nonzero flags, regex groups."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kiln.functions import (cut_expr, extract_group, groups_expr, mean_bins_expr, nonzero_expr, numeric, prefix_expr,
                            presence_expr, replace_expr, rules_expr)

# Mappings longer than this become a broadcast lookup table instead of a CASE chain
# (a driver-given mapping, so its size is known before the plan is built).
CASE_LIMIT = 200


def replace_values(df: DataFrame, c: str, mapping: Mapping | None = None, values: Sequence = (),
                   value=None, out: str | None = None) -> DataFrame:
    """Dict replace and/or list -> one value; other values kept."""
    spec = {v: value for v in values}
    spec.update(mapping or {})
    if len(spec) > CASE_LIMIT:
        return _lookup(df, c, spec, out or c)
    return df.withColumn(out or c, replace_expr(c, spec))


def _lookup(df: DataFrame, c: str, spec: Mapping, out: str) -> DataFrame:
    """As a CASE chain over ``spec``, result type included, by a lookup join with the driver-given table."""
    pairs = F.array(*[F.struct(F.lit(k).alias("_k"), F.lit(v).alias("_v")) for k, v in spec.items()])
    table = df.sparkSession.range(1).select(F.explode(pairs).alias("_p")).select("_p._k", "_p._v", F.lit(True).alias("_hit"))
    j = df.join(F.broadcast(table), F.col(c) == F.col("_k"), "left")
    return j.withColumn(out, F.when(F.col("_hit"), F.col("_v")).otherwise(F.col(c))).drop("_k", "_v", "_hit")


def recode_prefix(df: DataFrame, c: str, rules: Sequence[tuple[str, str]], out: str | None = None) -> DataFrame:
    """First matching prefix wins; unmatched and NULL kept."""
    return df.withColumn(out or c, prefix_expr(c, rules))


def recode_groups(df: DataFrame, c: str, groups: Mapping[str, Sequence], out: str | None = None) -> DataFrame:
    """Many codes -> one group label; unlisted values kept."""
    size = sum(len(v) for v in groups.values())
    if size > CASE_LIMIT:
        return _lookup(df, c, {v: lab for lab, vals in groups.items() for v in vals}, out or c)
    return df.withColumn(out or c, groups_expr(c, groups))


def cut(df: DataFrame, c: str, edges: Sequence[float], labels: Sequence[str], out: str | None = None) -> DataFrame:
    """Right-closed bins (a, b]; outside the edges or NULL -> NULL."""
    return df.withColumn(out or c, cut_expr(c, edges, labels))


def bin_by_rules(df: DataFrame, rules: Sequence[tuple[Column, str]], out: str) -> DataFrame:
    """E5: ordered (condition, label) list; unmatched -> NULL."""
    return df.withColumn(out, rules_expr(rules))


@dataclass(frozen=True)
class FittedMeanBins:
    """Mean of each column fitted on one table; the three labels on any table."""
    means: dict
    labels: tuple = ("none", "below", "above")

    def apply(self, df: DataFrame, suffix: str = "") -> DataFrame:
        return df.withColumns({c + suffix: mean_bins_expr(c, m, self.labels) for c, m in self.means.items()})


def fit_mean_bins(df: DataFrame, cols: Sequence[str], labels: Sequence[str] = ("none", "below", "above")) -> FittedMeanBins:
    row = df.agg(*[F.avg(numeric(c)).alias(c) for c in cols]).first()
    return FittedMeanBins({c: row[c] for c in cols}, tuple(labels))


def presence_flag(df: DataFrame, c: str, yes=1, no=0, out: str | None = None) -> DataFrame:
    """NULL -> ``no``, present -> ``yes``."""
    return df.withColumn(out or c, presence_expr(c, yes, no))


def nonzero_flag(df: DataFrame, c: str, out: str | None = None) -> DataFrame:
    """X != 0 -> 1; zero stays 0; NULL stays NULL."""
    return df.withColumn(out or c, nonzero_expr(c))


def extract_title(df: DataFrame, c: str, pattern: str = r" ([A-Za-z]+)\.", out: str = "title") -> DataFrame:
    """First regex group of the first match, '' when none."""
    return df.withColumn(out, extract_group(c, pattern, 1))
