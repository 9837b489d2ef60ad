"""Encoders (E9-E14): one-hot with fitted category lists, aligned train/test one-hot,
label indicator arrays, label encoding via a distributed lookup table, argmax decode."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.functions import argmax_index, one_hot_array
from kiln.operators.columns import columns_of_type
from kiln.operators.positions import positions
from kiln.session import materialize

# A fitted one-hot holds its category lists on the driver; fits refuse more than this many in
# total unless the caller allows more.
MAX_CATEGORIES = 1_000_000


def _distinct_values(dfs: Sequence[DataFrame], cols: Sequence[str], limit: int) -> dict[str, list]:
    """Sorted distinct non-null values per column over all ``dfs``: one distributed
    distinct of (column, value) pairs, checked for size before it is collected."""
    longs = [d.select([F.col(c).cast("string").alias(c) for c in cols]).unpivot([], list(cols), "_c", "_v")
             for d in dfs]
    long = longs[0]
    for other in longs[1:]:
        long = long.unionByName(other)
    pairs = long.filter(F.col("_v").isNotNull()).distinct()
    rows = pairs.limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"more than {limit} categories")
    found: dict[str, list] = {c: [] for c in cols}
    for r in rows:
        found[r["_c"]].append(r["_v"])
    return found


@dataclass(frozen=True)
class FittedOneHot:
    """Category list per column; ``apply`` adds ``prefix_value`` 0/1 columns."""
    categories: dict
    prefixes: dict = field(default_factory=dict)
    drop_first: bool = False

    def column_names(self) -> list[str]:
        names = []
        for c, cats in self.categories.items():
            p = self.prefixes.get(c, c)
            names += [f"{p}_{v}" for v in (cats[1:] if self.drop_first else cats)]
        return names

    def apply(self, df: DataFrame, as_vector: bool = False, out: str = "one_hot") -> DataFrame:
        """0/1 columns, or with ``as_vector`` one sparse vector column ``out`` in the same
        order. The form never depends on the data; ask for the vector where many hundred
        columns would come out (generated code has a method size limit)."""
        if as_vector:
            return self.apply_vector(df, out)
        keep = [F.col(c) for c in df.columns if c not in self.categories]
        dummies = []
        for c, cats in self.categories.items():
            p = self.prefixes.get(c, c)
            x = F.col(c).cast("string")
            for v in (cats[1:] if self.drop_first else cats):
                dummies.append(F.when(x == F.lit(v), 1).otherwise(0).alias(f"{p}_{v}"))
        return df.select(*keep, *dummies)

    def apply_vector(self, df: DataFrame, out: str = "one_hot") -> DataFrame:
        """One sparse vector per row, entries in ``column_names()`` order; NULL and unseen
        values (and the dropped first category) give no entry. Built from JVM stages:
        an indexer holding the fitted labels, the one-hot encoder, the assembler."""
        from pyspark.ml.feature import OneHotEncoder, StringIndexerModel, VectorAssembler

        x = df.withColumns({f"_s{i}": F.col(c).cast("string") for i, c in enumerate(self.categories)})
        vec_cols = []
        for i, (c, cats) in enumerate(self.categories.items()):
            used = cats[1:] if self.drop_first else cats
            idx = StringIndexerModel.from_labels(used, inputCol=f"_s{i}", outputCol=f"_i{i}", handleInvalid="keep")
            x = idx.transform(x)
            enc = OneHotEncoder(inputCols=[f"_i{i}"], outputCols=[f"_v{i}"], dropLast=True)  # drops the NULL slot
            x = enc.fit(x).transform(x)  # sizes come from the indexer's column metadata
            vec_cols.append(f"_v{i}")
        x = VectorAssembler(inputCols=vec_cols, outputCol=out).transform(x)
        keep = [c for c in df.columns if c not in self.categories]
        return x.select(*keep, out)


def _sort_values(values: list, numeric: bool) -> list:
    return sorted(values, key=float) if numeric else sorted(values)


def fit_one_hot(df: DataFrame | Sequence[DataFrame], cols: Sequence[str], prefixes: Mapping | Sequence | None = None,
                declared: Mapping[str, Sequence] | None = None, drop_first: bool = False,
                limit: int = MAX_CATEGORIES) -> FittedOneHot:
    """Sorted categories seen in ``df`` (or in all given tables -> E11) plus declared ones."""
    dfs = [df] if isinstance(df, DataFrame) else list(df)
    found = _distinct_values(dfs, cols, limit)
    numeric = set(columns_of_type(dfs[0], "number"))
    cats = {}
    for c in cols:
        vals = set(found[c]) | {str(v) for v in (declared or {}).get(c, [])}
        cats[c] = _sort_values(list(vals), c in numeric)
    if prefixes is None:
        pre = {}
    elif isinstance(prefixes, Mapping):
        pre = dict(prefixes)
    else:
        pre = dict(zip(cols, prefixes))
    return FittedOneHot(cats, pre, drop_first)


def one_hot(df: DataFrame, cols: Sequence[str], prefixes=None, declared=None, drop_first=False) -> DataFrame:
    """E9 fitted and applied on the same table."""
    return fit_one_hot(df, cols, prefixes, declared, drop_first).apply(df)


def one_hot_auto(df: DataFrame, exclude: Sequence[str] = ()) -> DataFrame:
    """Encode only string columns; numbers pass through."""
    return one_hot(df, columns_of_type(df, "string", exclude=exclude))


def one_hot_aligned(train: DataFrame, test: DataFrame, cols: Sequence[str], prefixes=None,
                    declared=None) -> tuple[DataFrame, DataFrame]:
    """Categories fitted on train and test together, so both get the same columns
    (the union is only scanned for distinct values, never materialised)."""
    fitted = fit_one_hot([train, test], cols, prefixes, declared)
    return fitted.apply(train), fitted.apply(test)


def one_hot_label(df: DataFrame, c: str, k: int | None = None, out: str = "one_hot") -> DataFrame:
    """Label 0..k-1 -> length-k 0/1 array (k = number of distinct labels if not given)."""
    if k is None:
        k = int(df.agg(F.countDistinct(c)).first()[0])
    return df.withColumn(out, one_hot_array(c, k))


@dataclass
class FittedLabelEncoder:
    """Value -> 0..k-1 in sorted order, held as a (checkpointed) Spark table."""
    column: str
    table: DataFrame  # (value, index)
    size: int

    def apply(self, df: DataFrame, out: str | None = None) -> DataFrame:
        t = self.table.withColumnRenamed("value", "_lv").withColumnRenamed("index", "_li")
        j = df.join(t, F.col(self.column) == F.col("_lv"), "left").drop("_lv")
        name = out or self.column
        if name == self.column:
            j = j.drop(self.column)
        return j.withColumnRenamed("_li", name)


def fit_label_encoder(df: DataFrame, c: str, classes: Sequence | None = None) -> FittedLabelEncoder:
    """Sorted distinct values numbered by a range-partitioned position pass."""
    spark = df.sparkSession
    if classes is not None:
        vals = sorted(set(classes))
        table = spark.createDataFrame([(v, i) for i, v in enumerate(vals)], ["value", "index"])
        return FittedLabelEncoder(c, table, len(vals))
    distinct = df.select(F.col(c).alias("value")).filter(F.col("value").isNotNull()).distinct()
    table = materialize(positions(distinct, ["value"], name="index"))
    return FittedLabelEncoder(c, table, table.count())


def argmax_decode(df: DataFrame, arr: str, out: str = "label") -> DataFrame:
    """Index of the largest score (first on ties)."""
    return df.withColumn(out, argmax_index(arr))
