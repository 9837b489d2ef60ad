"""Sorting, top-k, shuffling and splitting.

Random choices are hashes of a key column and a seed, so a split or fold is
the same on every run and under any partitioning, and recomputing a lost
partition gives the same rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kiln.operators.positions import positions
from kiln.operators.stats import attach_stats


def sort_desc(df: DataFrame, c: str, key: Sequence[str] = ()) -> DataFrame:
    """O1: descending order (ties by ``key`` ascending)."""
    return df.orderBy(F.desc_nulls_last(c), *key)


def top_k(df: DataFrame, c: str, k: int, skip: int = 0, key: Sequence[str] = ()) -> DataFrame:
    """O2: rows skip..skip+k-1 of the descending order (a bounded top-k, no full sort)."""
    ordered = df.orderBy(F.desc_nulls_last(c), *key)
    return ordered.offset(skip).limit(k) if skip else ordered.limit(k)


def hash_number(key: str | Sequence[str], seed: int) -> Column:
    """52-bit number from the leading 13 hex digits of md5("seed|key|..."), which any SQL engine computes
    alike; a NULL key counts as the text ``NULL``."""
    keys = [key] if isinstance(key, str) else list(key)
    text = F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(F.col(k).cast("string"), F.lit("NULL")) for k in keys])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("long")


def uniform(key: str | Sequence[str], seed: int) -> Column:
    """Deterministic U[0, 1) from a hash of the key columns and the seed."""
    return hash_number(key, seed).cast("double") / float(1 << 52)


def shuffle_rows(df: DataFrame, key: str | Sequence[str], seed: int = 42) -> DataFrame:
    """O3: repeatable random order."""
    keys = [key] if isinstance(key, str) else list(key)
    return df.orderBy(hash_number(keys, seed), *keys)


def train_test_split(df: DataFrame, key: str | Sequence[str], train_frac: float = 0.7,
                     seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Hash-threshold split; stable under repartitioning and recomputation."""
    u = uniform(key, seed)
    return df.filter(u < train_frac), df.filter(u >= train_frac)


def stratified_split(df: DataFrame, label: str, key: str, train_frac: float = 0.7,
                     seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Exact class shares: each class's rows ranked by hash; the first
    round(frac * n_class) go to train. Ranking uses range-partitioned positions,
    so a dominant class is spread over many tasks."""
    h = df.withColumn("_h", hash_number(key, seed))
    ranked = positions(h, ["_h", key], [label], name="_pos")
    sizes = df.groupBy(label).agg(F.count(F.lit(1)).alias("_n"))
    ranked = attach_stats(ranked, sizes, [label])
    is_train = F.col("_pos") < F.round(F.col("_n") * F.lit(train_frac))
    drop = ["_h", "_pos", "_n"]
    return ranked.filter(is_train).drop(*drop), ranked.filter(~is_train).drop(*drop)


def fold_of(pos: Column, n: Column, k: int) -> Column:
    """ntile(k) - 1 for a 0-based position among n rows: the first n % k folds get one extra row."""
    q = F.floor(n / k)
    r = n - q * k
    big = r * (q + 1)
    return F.when(pos < big, F.floor(pos / (q + 1))).otherwise(r + F.floor((pos - big) / q)).cast("int")


def stratified_folds(df: DataFrame, label: str | None, key: str, k: int = 10, name: str = "fold") -> DataFrame:
    """Contiguous, unshuffled folds in ``key`` order inside each class (class sizes per
    fold differ by at most one); ``label=None`` gives plain k-fold."""
    groups = [label] if label else []
    ranked = positions(df, [key], groups, name="_pos")
    sizes = df.groupBy(*groups).agg(F.count(F.lit(1)).alias("_n"))
    ranked = attach_stats(ranked, sizes, groups)
    return ranked.withColumn(name, fold_of(F.col("_pos"), F.col("_n"), k)).drop("_pos", "_n")
