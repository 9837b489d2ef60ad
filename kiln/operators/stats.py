"""Aggregates and descriptive statistics.

All statistics of one fit are gathered in a single aggregate (partial
aggregation on the executors, one small row to the driver). Quantiles are
exact and skew-safe (see ``quantiles``); modes use a distributed group-by.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.functions import numeric
from kiln.operators.missing import mode_of
from kiln.operators.positions import null_safe_join
from kiln.operators.quantiles import column_quantiles, quantiles
from kiln.session import spread

# Aggregate expressions per job when a statistic needs one per column pair.
AGG_CHUNK = 200


def _long(values: list[tuple], schema: str, spark) -> DataFrame:
    return spark.createDataFrame(values, schema)


def attach_stats(data: DataFrame, stats: DataFrame, groups: Sequence[str]) -> DataFrame:
    """Give every row its group's fitted statistics: a lookup join on the group key (NULL is a
    group too; adaptive execution broadcasts a small side), or literals for the global case."""
    if not groups:
        row = stats.first()
        return data.withColumns({c: F.lit(row[c]) for c in stats.columns})
    return null_safe_join(data, stats, groups, "inner")


def conditional_rate(df: DataFrame, group: str | Sequence[str], flag: str, name: str = "rate") -> DataFrame:
    """A1: share of a 0/1 column per subgroup, in percent, with group sizes."""
    groups = [group] if isinstance(group, str) else list(group)
    return df.groupBy(*groups).agg((F.avg(F.col(flag).cast("double")) * 100.0).alias(name),
                                   F.count(F.lit(1)).alias("n"))


def basic_stats(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """A2: count, sum, mean, min, max per column (one aggregate, long output)."""
    aggs = []
    for i, c in enumerate(cols):
        x = numeric(c)
        aggs += [F.count(x).alias(f"n{i}"), F.sum(x).alias(f"s{i}"), F.avg(x).alias(f"m{i}"),
                 F.min(x).alias(f"lo{i}"), F.max(x).alias(f"hi{i}")]
    wide = df.agg(*aggs)
    rows = [F.struct(F.lit(c).alias("column"), F.col(f"n{i}").alias("count"), F.col(f"s{i}").alias("sum"),
                     F.col(f"m{i}").alias("mean"), F.col(f"lo{i}").alias("min"), F.col(f"hi{i}").alias("max"))
            for i, c in enumerate(cols)]
    return wide.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def medians(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """A3: exact median per column, all columns in the same passes."""
    return column_quantiles(df, cols, [0.5]).select("column", F.col("value").alias("median"))


def modes(df: DataFrame, cols: Sequence[str]) -> dict:
    """A3: most frequent value per column (ties -> smallest)."""
    return {c: mode_of(df, c) for c in cols}


def skewness(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """A4: bias-corrected sample skewness G1 = g1 * sqrt(n(n-1)) / (n-2) per column,
    NULLs ignored; sorted descending. Zero variance -> 0 (as pandas); n < 3 -> NULL."""
    aggs = []
    for i, c in enumerate(cols):
        x = numeric(c)
        aggs += [F.skewness(x).alias(f"g{i}"), F.count(x).alias(f"n{i}"), F.var_pop(x).alias(f"v{i}")]
    wide = df.agg(*aggs)
    rows = []
    for i, c in enumerate(cols):
        n, g, v = F.col(f"n{i}").cast("double"), F.col(f"g{i}"), F.col(f"v{i}")
        G = (F.when(n < 3, F.lit(None).cast("double"))
             .when(v == 0, F.lit(0.0))
             .otherwise(g * F.sqrt(n * (n - 1)) / (n - 2)))
        rows.append(F.struct(F.lit(c).alias("column"), G.alias("skew")))
    out = wide.select(F.explode(F.array(*rows)).alias("r")).select("r.*")
    return out.orderBy(F.desc_nulls_last("skew"), "column")


def skew_values(df: DataFrame, cols: Sequence[str]) -> dict:
    return {r["column"]: r["skew"] for r in skewness(df, cols).collect()}


def correlation_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """A5: Pearson r for every ordered pair (a, b), pairwise-complete rows; long form.
    The d(d+1)/2 distinct pairs are computed in aggregate jobs of AGG_CHUNK expressions."""
    pairs = [(a, a) for a in cols] + list(combinations(cols, 2))
    got = {}
    for s in range(0, len(pairs), AGG_CHUNK):
        chunk = pairs[s:s + AGG_CHUNK]
        row = df.agg(*[F.corr(numeric(a), numeric(b)).alias(f"r{k}")
                       for k, (a, b) in enumerate(chunk)]).first()
        for k, (a, b) in enumerate(chunk):
            got[(a, b)] = got[(b, a)] = row[f"r{k}"]
    idx = {c: i for i, c in enumerate(cols)}
    values = [(a, b, idx[a], idx[b], got[(a, b)]) for a in cols for b in cols]
    return _long(values, "a string, b string, ia int, ib int, r double", df.sparkSession)


def correlation_lower(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Strict lower triangle (the heat-map mask hides the upper half and the diagonal)."""
    return correlation_matrix(df, cols).filter(F.col("ia") > F.col("ib"))


def top_correlated(df: DataFrame, target: str, cols: Sequence[str], k: int = 5) -> DataFrame:
    """The k columns with largest |r| against ``target`` (target itself excluded)."""
    others = [c for c in cols if c != target]
    row = df.agg(*[F.corr(numeric(c), numeric(target)).alias(f"r{i}")
                   for i, c in enumerate(others)]).first()
    vals = [(c, row[f"r{i}"]) for i, c in enumerate(others)]
    t = _long(vals, "column string, r double", df.sparkSession)
    return t.orderBy(F.desc_nulls_last(F.abs("r")), "column").limit(k)


def category_values(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Sorted distinct values per listed column (distributed distinct)."""
    long = df.select([F.col(c).cast("string").alias(c) for c in cols]).unpivot([], list(cols), "column", "value")
    return long.filter(F.col("value").isNotNull()).distinct().orderBy("column", "value")


def distinct_count(df: DataFrame, c: str, approx: bool = False) -> DataFrame:
    """Number of distinct non-null values (HyperLogLog++ when ``approx``)."""
    f = F.approx_count_distinct(c) if approx else F.countDistinct(c)
    return df.agg(f.alias("n_distinct"))


def histogram(df: DataFrame, c: str, bins: int = 30, by: str | None = None) -> DataFrame:
    """A10: equal-width bins over [min, max] of each ``by`` group (the last bin closed);
    rows (by, bin, lo, hi, count) for every bin, empty ones included."""
    groups = [by] if by else []
    x = numeric(c)
    rng = df.groupBy(*groups).agg(F.min(x).alias("_lo"), F.max(x).alias("_hi"))
    width = (F.col("_hi") - F.col("_lo")) / bins
    data = df.select(*groups, x.alias("_x")).filter(F.col("_x").isNotNull())
    j = attach_stats(data, rng, groups)
    b = F.when(width > 0, F.least(F.floor((F.col("_x") - F.col("_lo")) / width), F.lit(bins - 1))).otherwise(0)
    counts = j.groupBy(*groups, b.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    grid = rng.select(*groups, "_lo", "_hi", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    out = null_safe_join(grid, counts, [*groups, "bin"], "left")  # both sides: (groups x bins) rows
    return out.select(*groups, "bin", (F.col("_lo") + F.col("bin") * width).alias("lo"),
                      (F.col("_lo") + (F.col("bin") + 1) * width).alias("hi"),
                      F.coalesce(F.col("count"), F.lit(0)).alias("count"))


def boxplot_stats(df: DataFrame, c: str, by: str | None = None, whisker: float = 1.5) -> DataFrame:
    """q1, median, q3 (exact, linear), whiskers at the most extreme values within
    ``whisker`` x IQR of the quartiles, outlier count; per ``by`` group if given."""
    groups = [by] if by else []
    q = quantiles(df, c, [0.25, 0.5, 0.75], groups)
    qw = q.groupBy(*groups).agg(*[F.max(F.when(F.col("p") == p, F.col("value"))).alias(n)
                                  for p, n in ((0.25, "q1"), (0.5, "median"), (0.75, "q3"))])
    qw = qw.withColumn("iqr", F.col("q3") - F.col("q1"))
    x = numeric(c)
    data = df.select(*groups, x.alias("_x")).filter(F.col("_x").isNotNull() & ~F.isnan("_x"))
    j = attach_stats(data, qw, groups)
    lo_f = F.col("q1") - whisker * F.col("iqr")
    hi_f = F.col("q3") + whisker * F.col("iqr")
    inside = (F.col("_x") >= lo_f) & (F.col("_x") <= hi_f)
    w = j.groupBy(*groups).agg(F.min(F.when(inside, F.col("_x"))).alias("whisker_lo"),
                               F.max(F.when(inside, F.col("_x"))).alias("whisker_hi"),
                               F.count(F.when(~inside, 1)).alias("n_outliers"),
                               F.count(F.lit(1)).alias("n"))
    if not groups:
        return attach_stats(w, qw, [])
    return null_safe_join(qw, w, groups, "inner")


def kde_curve(df: DataFrame, c: str, grid: int = 200, cut: float = 3.0) -> DataFrame:
    """Gaussian kernel density on ``grid`` points from min - cut*h to max + cut*h,
    Scott bandwidth h = n^(-1/5) * sample std. Every task adds its rows to one grid-sized array
    in Arrow batches and passes on that array only."""
    x = numeric(c)
    s = df.agg(F.count(x).alias("n"), F.stddev_samp(x).alias("sd"), F.min(x).alias("lo"),
               F.max(x).alias("hi")).first()
    n, sd = s["n"], s["sd"]
    if not n or sd is None or sd == 0:
        return df.sparkSession.createDataFrame([], "i int, x double, density double")
    h = sd * n ** (-0.2)
    lo, hi = s["lo"] - cut * h, s["hi"] + cut * h
    step = (hi - lo) / (grid - 1)

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        points, total = lo + np.arange(grid) * step, np.zeros(grid)
        for pdf in batches:
            v = pdf["_x"].to_numpy()
            for k in range(0, len(v), 4096):
                total += np.exp(-0.5 * ((points[None, :] - v[k:k + 4096, None]) / h) ** 2).sum(0)
        yield pd.DataFrame({"i": np.arange(grid, dtype=np.int32), "_s": total})

    data = spread(df.select(x.alias("_x")).filter(F.col("_x").isNotNull()))
    dens = data.mapInPandas(add, "i int, _s double").groupBy("i").agg(F.sum("_s").alias("_s"))
    norm = 1.0 / (n * h * (2 * 3.141592653589793) ** 0.5)
    return dens.select("i", (F.lit(lo) + F.col("i") * F.lit(step)).alias("x"), (F.col("_s") * norm).alias("density"))


def zscores(df: DataFrame, cols: Sequence[str], keep: Sequence[str] = (), suffix: str = "") -> DataFrame:
    """(x - mean) / population std per column (fitted and applied on ``df``)."""
    from kiln.operators.transform import fit_zscore

    return fit_zscore(df, cols).apply(df, keep=keep, suffix=suffix)
