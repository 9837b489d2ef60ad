"""Dense positions and running sums in a global (or per-group) order without a
single-partition window.

Plan: range-partition + sort by (group, order) -> a written copy with each row's partition and
place (fixes the sampled range bounds, so both passes see the same partitions) -> per
(partition, group) counts -> offsets over that small table -> add the offset to
the row's index inside its partition. A hot group simply spans many range
partitions; no task ever holds more than one partition.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kiln.session import staged

# Offset tables (one row per partition x group present in it) up to this many rows are broadcast.
BROADCAST_ROWS = 2_000_000


def null_safe_join(left: DataFrame, right: DataFrame, cols: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on ``cols`` with NULL equal to NULL; the key columns are the left side's."""
    renamed = right.withColumnsRenamed({c: f"_r_{c}" for c in cols})
    cond = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_r_{c}")) for c in cols])
    return left.join(renamed, cond, how).drop(*[f"_r_{c}" for c in cols])


def sorted_checkpoint(df: DataFrame, keys: Sequence) -> DataFrame:
    """Sorted copy written to the shared checkpoint folder, with partition id and
    in-partition index columns ``_pid`` / ``_mid`` as they were when it was written."""
    ordered = df.orderBy(*keys)
    return staged(ordered.withColumns({"_pid": F.spark_partition_id(), "_mid": F.monotonically_increasing_id()}), "sorted")


def _attach(ck: DataFrame, small: DataFrame, group_cols: Sequence[str]) -> DataFrame:
    keys = ["_pid", *group_cols]
    n = small.count()
    right = small.select([F.col(k).alias(f"_r{k}") for k in keys] +
                         [F.col(c) for c in small.columns if c not in keys])
    cond = reduce(lambda a, b: a & b, [ck[k].eqNullSafe(right[f"_r{k}"]) for k in keys])
    joined = ck.join(F.broadcast(right) if n <= BROADCAST_ROWS else right, cond, "inner")
    return joined.drop(*[f"_r{k}" for k in keys])


def positions(df: DataFrame, order_cols: Sequence, group_cols: Sequence[str] = (),
              name: str = "pos") -> DataFrame:
    """Add ``name`` = 0-based row number in ``order_cols`` order (within ``group_cols``).

    ``order_cols`` should make the order total, otherwise ties are broken by
    the materialised partition order (still deterministic once computed)."""
    group_cols = list(group_cols)
    ck = sorted_checkpoint(df, [*group_cols, *order_cols])
    stats = ck.groupBy("_pid", *group_cols).agg(F.count(F.lit(1)).alias("_c"), F.min("_mid").alias("_base"))
    w = Window.partitionBy(*group_cols).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    stats = stats.withColumn("_off", F.coalesce(F.sum("_c").over(w), F.lit(0)))
    out = _attach(ck, stats.select("_pid", *group_cols, "_off", "_base"), group_cols)
    out = out.withColumn(name, (F.col("_off") + F.col("_mid") - F.col("_base")).cast("long"))
    return out.drop("_pid", "_mid", "_off", "_base")


def running_sum(df: DataFrame, order_cols: Sequence, value_col: str, group_cols: Sequence[str] = (),
                name: str = "cum", inclusive: bool = True) -> DataFrame:
    """Running sum of ``value_col`` in ``order_cols`` order (within groups).

    Per-partition partial sums are combined through the small (partition, group)
    table; the in-partition running sum is a window keyed by (partition, group),
    whose size is bounded by one partition."""
    group_cols = list(group_cols)
    ck = sorted_checkpoint(df, [*group_cols, *order_cols])
    stats = ck.groupBy("_pid", *group_cols).agg(F.sum(value_col).alias("_s"))
    w = Window.partitionBy(*group_cols).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    stats = stats.withColumn("_off", F.coalesce(F.sum("_s").over(w), F.lit(0))).drop("_s")
    frame_end = 0 if inclusive else -1
    wl = Window.partitionBy("_pid", *group_cols).orderBy("_mid").rowsBetween(Window.unboundedPreceding, frame_end)
    local = ck.withColumn("_loc", F.coalesce(F.sum(value_col).over(wl), F.lit(0)))
    out = _attach(local, stats, group_cols)
    out = out.withColumn(name, F.col("_off") + F.col("_loc"))
    return out.drop("_pid", "_mid", "_off", "_loc")


def counted_parts(df: DataFrame, part: str, count: str) -> tuple[DataFrame, dict[int, int], int]:
    """A written copy of ``df``, one row per part in the parts' order, what comes before each part (the sum of ``count``
    over the parts before it) and the sum over all. The driver holds one number per part."""
    kept = staged(df, "parts")
    before, total = {}, 0
    for r in sorted(kept.select(part, count).collect()):
        before[r[0]] = total
        total += r[1]
    return kept, before, total
