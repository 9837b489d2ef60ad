"""Exact quantiles (linear interpolation, as numpy/pandas ``linear`` and DuckDB ``quantile_cont``) of many columns,
per group, without unpivoting or caching the table and without holding a group in one task.

1. One pass makes a mergeable sketch per column (``percentile_approx``) of every group and takes from it a bracket
   [a, b] around each wanted rank.
2. One pass counts what lies below and in each bracket. A bracket that missed its ranks is opened on that side and
   counted again; one that still holds more than ``BAND_DISTINCT`` distinct values is narrowed by a sketch of the values
   in it, some 250-fold each time.
3. One filtered pass keeps the rows of the wide table that lie in some bracket, and only there splits them into
   (column, value); distinct values are counted and ranked by a window whose size is bounded by ``BAND_DISTINCT``.

Without groups the brackets are literals, so the filter of the last pass reaches the scan. With groups they are one row
per group, attached by a lookup join that adaptive execution broadcasts by its bytes.

Null and NaN values take no part; a null group is a group; groups without values are absent.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kiln.operators.positions import null_safe_join
from kiln.session import staged

ACCURACY = 1_000
BAND_DISTINCT = 100_000
MAX_ROUNDS = 40
_INF = float("inf")


def _value(c: str) -> Column:
    x = F.col(c).cast("double")
    return F.when(~F.isnan(x), x)


class _Brackets:
    """Targets (column, probability), numbered, and per group arrays over them: values n of the column, bracket [a, b],
    rows below and inside it, and ranks low and high."""

    def __init__(self, df: DataFrame, cols: Sequence[str], probs: Sequence[float], groups: Sequence[str], accuracy: int):
        self.keys = [f"_g{i}" for i in range(len(groups))]
        self.accuracy = accuracy
        self.data = df.select(*[F.col(g).alias(k) for g, k in zip(groups, self.keys)],
                              *[_value(c).alias(f"_x{k}") for k, c in enumerate(cols)])
        self.targets = [(k, float(p)) for k in range(len(cols)) for p in probs]
        eps = 2.0 / accuracy
        wanted = F.array(*[F.lit(q) for p in probs for q in (max(0.0, p - eps), min(1.0, p + eps))])
        sketch = self.data.groupBy(*self.keys).agg(*[x for k in range(len(cols)) for x in (
            F.count(f"_x{k}").alias(f"n{k}"), F.percentile_approx(f"_x{k}", wanted, accuracy).alias(f"s{k}"))])
        place = [2 * i for _ in cols for i in range(len(probs))]
        n = [F.col(f"n{k}") for k, _ in self.targets]
        last = [(x - 1) * F.lit(p) for x, (_, p) in zip(n, self.targets)]
        self._hold(sketch.select(
            *self.keys, F.array(*n).alias("n"), F.array(*[F.col(f"s{k}")[i] for (k, _), i in zip(self.targets, place)]).alias("a"),
            F.array(*[F.col(f"s{k}")[i + 1] for (k, _), i in zip(self.targets, place)]).alias("b"),
            F.array(*[F.floor(h) for h in last]).alias("low"), F.array(*[F.ceil(h) for h in last]).alias("high")))
        self.count()

    def _hold(self, table: DataFrame) -> None:
        """Without groups there is one row: its numbers become literals. Groups stay in Spark."""
        if self.keys:
            self.table = staged(table, "brackets")
        else:
            self.row = table.first()

    def at(self, name: str, t: int) -> Column:
        if self.keys:
            return F.col(name)[t]
        value = self.row[name][t]
        return F.lit(value).cast("double" if name in "ab" else "long")

    def inside(self, t: int) -> Column:
        x = F.col(f"_x{self.targets[t][0]}")
        return (x >= self.at("a", t)) & (x <= self.at("b", t))

    def joined(self, *names: str) -> DataFrame:
        """The data, with each group's arrays."""
        return null_safe_join(self.data, self.table.select(*self.keys, *names), self.keys) if self.keys else self.data

    def updated(self, aggs: dict[str, list[Column]], keep: Sequence[str]) -> None:
        """New arrays from aggregates over the data, besides those of ``keep``."""
        flat = [a.alias(f"{name}{t}") for name, of in aggs.items() for t, a in enumerate(of)]
        found = self.joined("a", "b").groupBy(*self.keys).agg(*flat)
        arrays = [F.array(*[F.col(f"{name}{t}") for t in range(len(of))]).alias(name) for name, of in aggs.items()]
        found = found.select(*self.keys, *arrays)
        if self.keys:
            self._hold(null_safe_join(self.table.select(*self.keys, *keep), found, self.keys))
        else:
            self.row = {**{k: self.row[k] for k in keep}, **found.first().asDict()}

    def count(self) -> None:
        """Rows below and inside every bracket; brackets that missed a rank are opened and counted again."""
        size = range(len(self.targets))
        kept = ("n", "a", "b", "low", "high")
        for _ in range(2):
            self.updated({"below": [F.count_if(F.col(f"_x{k}") < self.at("a", t)) for t, (k, _) in enumerate(self.targets)],
                          "inside": [F.count_if(self.inside(t)) for t in size]}, kept)
            early = [self.at("low", t) < self.at("below", t) for t in size]
            late = [self.at("high", t) >= self.at("below", t) + self.at("inside", t) for t in size]
            missed = reduce(lambda x, y: x | y, [F.coalesce(c, F.lit(False)) for c in (*early, *late)])
            a = F.array(*[F.when(c, -_INF).otherwise(self.at("a", t)) for t, c in zip(size, early)])
            b = F.array(*[F.when(c, _INF).otherwise(self.at("b", t)) for t, c in zip(size, late)])
            if self.keys:
                if not self.table.where(missed).count():
                    return
                self._hold(self.table.withColumns({"a": a, "b": b}))
            else:
                one = self.data.sparkSession.range(1).select(missed.alias("m"), a.alias("a"), b.alias("b")).first()
                if not one["m"]:
                    return
                self.row = {**self.row, "a": one["a"], "b": one["b"]}

    def widest(self) -> int:
        """Rows of the fullest bracket."""
        if not self.keys:
            return max(self.row["inside"], default=0)
        return self.table.agg(F.max(F.array_max("inside"))).first()[0] or 0

    def distinct(self) -> int:
        """Distinct values of the fullest bracket, about."""
        found = self.joined("a", "b").groupBy(*self.keys).agg(F.greatest(F.lit(0), *[
            F.approx_count_distinct(F.when(self.inside(t), F.col(f"_x{k}"))) for t, (k, _) in enumerate(self.targets)]).alias("m"))
        return found.agg(F.max("m")).first()[0] or 0

    def narrow(self) -> None:
        """Brackets from sketches of the values inside the present ones."""
        eps = 2.0 / self.accuracy
        share = lambda name, t, d: F.least(F.greatest(
            F.try_divide(self.at(name, t) - self.at("below", t) + 0.5, self.at("inside", t)) + d, F.lit(0.0)), F.lit(1.0))
        # The wanted shares differ by group, so the sketch gives evenly spaced ones and the nearest outer two are taken.
        steps = max(2, int(1 / eps))
        grid = F.array(*[F.lit(i / steps) for i in range(steps + 1)])
        sketch = [F.percentile_approx(F.when(self.inside(t), F.col(f"_x{k}")), grid, self.accuracy)
                  for t, (k, _) in enumerate(self.targets)]
        kept = ("n", "a", "b", "low", "high", "below", "inside")
        self.updated({"sketch": sketch}, kept)
        size = range(len(self.targets))
        first = [F.floor(share("low", t, -eps) * steps).cast("int") for t in size]
        last = [F.least(F.ceil(share("high", t, eps) * steps).cast("int"), F.lit(steps)) for t in size]
        if self.keys:
            cut = lambda t, i: F.get(F.col("sketch")[t], i)
            self._hold(self.table.withColumns({
                "a": F.array(*[F.coalesce(cut(t, i), self.at("a", t)) for t, i in zip(size, first)]),
                "b": F.array(*[F.coalesce(cut(t, i), self.at("b", t)) for t, i in zip(size, last)])}))
        else:
            one = self.data.sparkSession.range(1).select(F.array(*first).alias("i"), F.array(*last).alias("j")).first()
            pick = lambda t, i, old: old if self.row["sketch"][t] is None or i is None else self.row["sketch"][t][i]
            self.row = {**self.row, "a": [pick(t, one["i"][t], self.row["a"][t]) for t in size],
                        "b": [pick(t, one["j"][t], self.row["b"][t]) for t in size]}
        self.count()

    def values(self) -> DataFrame:
        """(keys, t, low value, high value) of every target with values."""
        size = range(len(self.targets))
        rows = self.joined("a", "b").where(reduce(lambda x, y: x | y, [self.inside(t) for t in size]))
        hits = F.array(*[F.when(self.inside(t), F.struct(F.lit(t).alias("t"), F.col(f"_x{k}").alias("x")))
                         for t, (k, _) in enumerate(self.targets)])
        found = rows.select(*self.keys, F.inline(F.filter(hits, lambda h: h.isNotNull()))).groupBy(*self.keys, "t", "x").count()
        upto = Window.partitionBy(*self.keys, "t").orderBy("x").rowsBetween(Window.unboundedPreceding, 0)
        found = found.withColumn("upto", F.sum("count").over(upto))
        if self.keys:
            known = self.table.select(*self.keys, F.posexplode(F.arrays_zip("low", "high", "below")).alias("t", "z")).select(
                *self.keys, "t", "z.low", "z.high", "z.below")
        else:
            known = self.data.sparkSession.createDataFrame(
                [(t, self.row["low"][t], self.row["high"][t], self.row["below"][t]) for t in size if self.row["n"][t]],
                "t int, low long, high long, below long")
        found = null_safe_join(found, known, [*self.keys, "t"])
        end = F.col("below") + F.col("upto")
        holds = lambda r: (end - F.col("count") <= F.col(r)) & (F.col(r) < end)
        return (found.where(holds("low") | holds("high")).groupBy(*self.keys, "t")
                .agg(F.max(F.when(holds("low"), F.col("x"))).alias("x0"), F.max(F.when(holds("high"), F.col("x"))).alias("x1")))


def column_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float], group_cols: Sequence[str] = (),
                     accuracy: int = ACCURACY, band_distinct: int = BAND_DISTINCT) -> DataFrame:
    """Rows (group..., column, p, value): exact linear-interpolation quantiles of the non-null, non-NaN values."""
    groups = list(group_cols)
    w = _Brackets(df, cols, probs, groups, accuracy)
    for _ in range(MAX_ROUNDS):
        # Fewer rows have no more distinct values.
        if w.widest() <= band_distinct or w.distinct() <= band_distinct:
            break
        w.narrow()
    found = w.values()
    n = (F.map_from_arrays(F.array(*[F.lit(t) for t in range(len(w.targets))]), F.col("n"))[F.col("t")] if groups else
         F.array(*[F.lit(x).cast("long") for x in w.row["n"]])[F.col("t")])
    if groups:
        found = null_safe_join(found, w.table.select(*w.keys, "n"), w.keys)
    names = F.array(*[F.lit(cols[k]) for k, _ in w.targets])
    ps = F.array(*[F.lit(p) for _, p in w.targets])
    h = (n - 1) * ps[F.col("t")]
    return found.select(*[F.col(k).alias(g) for k, g in zip(w.keys, groups)], names[F.col("t")].alias("column"), ps[F.col("t")].alias("p"),
                        (F.col("x0") + (h - F.floor(h)) * (F.col("x1") - F.col("x0"))).alias("value"))


def quantiles(df: DataFrame, x: str, probs: Sequence[float], group_cols: Sequence[str] = (),
              accuracy: int = ACCURACY, band_distinct: int = BAND_DISTINCT) -> DataFrame:
    """Rows (group..., p, value) of one column."""
    return column_quantiles(df, [x], probs, group_cols, accuracy, band_distinct).drop("column")


def quantile_values(df: DataFrame, x: str, probs: Sequence[float]) -> list[float | None]:
    """Global exact quantiles as Python floats (collects len(probs) rows)."""
    got = {r["p"]: r["value"] for r in quantiles(df, x, probs).collect()}
    return [got.get(float(p)) for p in probs]


def median_value(df: DataFrame, x: str) -> float | None:
    return quantile_values(df, x, [0.5])[0]
