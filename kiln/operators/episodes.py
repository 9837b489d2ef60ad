"""Episode (trajectory) tables (G1-G8): recorded transitions (episode, step, reward, ...).

No operator windows over a whole episode: one episode may hold a third of all
rows. Steps are dense 0..n-1 (see ``steps``), so "next step" is an equi-join on
(episode, step + 1) and running sums work on fixed-size step blocks.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kiln.operators.ordering import hash_number
from kiln.operators.positions import positions
from kiln.operators.stats import attach_stats

MAX_BLOCK = 1 << 16


def steps(df: DataFrame, episode: str, order_cols: Sequence, name: str = "step") -> DataFrame:
    """Dense 0-based step number per episode in ``order_cols`` order (skew-safe positions)."""
    return positions(df, order_cols, [episode], name=name)


def _block_size(gamma: float) -> int:
    """Largest block with gamma^block >= ~1e-200, so in-block rescaling never under/overflows."""
    if gamma >= 1.0:
        return MAX_BLOCK
    return max(1, min(MAX_BLOCK, int(460.0 / -math.log(gamma))))


def discounted_returns(df: DataFrame, episode: str, step: str, reward: str, gamma: float = 0.99,
                       out: str = "ret", block: int | None = None, _level: int = 0) -> DataFrame:
    """G1: G_t = r_t + gamma * G_{t+1} within each episode, in time order.

    Steps are cut into blocks of S steps. Inside a block, G is a suffix sum of
    r * gamma^(offset) rescaled by gamma^-offset (window keyed by (episode, block),
    at most S rows). The return at the start of the next block is carried in with
    gamma^(S - offset). Block starts come from the same recursion one level up
    (on the far smaller block table), or, when gamma^S is below double range,
    from the next three blocks (further terms underflow to zero)."""
    S = block or _block_size(gamma)
    blk, off, loc, nxt_c, B = (f"_blk{_level}", f"_off{_level}", f"_loc{_level}", f"_next{_level}", f"_B{_level}")
    x = df.withColumn(blk, F.floor(F.col(step) / S).cast("long"))
    x = x.withColumn(off, (F.col(step) - F.col(blk) * S).cast("int"))
    scaled = F.col(reward) * F.pow(F.lit(gamma), F.col(off))
    w = Window.partitionBy(episode, blk).orderBy(step).rowsBetween(Window.currentRow, Window.unboundedFollowing)
    x = x.withColumn(loc, F.sum(scaled).over(w) / F.pow(F.lit(gamma), F.col(off)))
    if (x.agg(F.max(blk)).first()[0] or 0) == 0:
        return x.withColumn(out, F.col(loc)).drop(blk, off, loc)

    blocks = x.groupBy(episode, blk).agg(F.sum(scaled).alias(B))
    g_s = gamma ** S
    if g_s > 1e-150:
        starts = discounted_returns(blocks, episode, blk, B, g_s, out="_start", _level=_level + 1)
    else:
        starts = blocks
        total = F.col(B)
        for k in (1, 2, 3):
            ahead = blocks.select(episode, (F.col(blk) - k).alias(blk), F.col(B).alias(f"{B}_{k}"))
            starts = starts.join(ahead, [episode, blk], "left")
            total = total + F.lit(g_s ** k) * F.coalesce(F.col(f"{B}_{k}"), F.lit(0.0))
        starts = starts.select(episode, blk, total.alias("_start"))
    nxt = starts.select(episode, (F.col(blk) - 1).alias(blk), F.col("_start").alias(nxt_c))
    x = x.join(nxt, [episode, blk], "left")
    carry = F.pow(F.lit(gamma), F.lit(S) - F.col(off)) * F.coalesce(F.col(nxt_c), F.lit(0.0))
    return x.withColumn(out, F.col(loc) + carry).drop(blk, off, loc, nxt_c)


def normalize_returns(df: DataFrame, episode: str, ret: str, out: str = "ret_norm", eps: float = 1e-8) -> DataFrame:
    """(G - mean) / (population std + eps) per episode (group stats joined back)."""
    st = df.groupBy(episode).agg(F.avg(ret).alias("_m"), F.stddev_pop(ret).alias("_sd"))
    j = attach_stats(df, st, [episode])
    return j.withColumn(out, (F.col(ret) - F.col("_m")) / (F.col("_sd") + eps)).drop("_m", "_sd")


def episode_scores(df: DataFrame, episode: str, reward: str) -> DataFrame:
    """Total reward and length per episode."""
    return df.groupBy(episode).agg(F.sum(reward).alias("score"), F.count(F.lit(1)).alias("steps"))


def trailing_mean(df: DataFrame, order_col: str, value: str, n: int = 50, out: str = "trailing_mean",
                  bucket_rows: int = 1 << 20) -> DataFrame:
    """Mean of the last <= n values in ``order_col`` order.

    Rows get dense positions, are cut into buckets of ``bucket_rows``, and the last
    n-1 rows of each bucket are copied into the next one as a halo; the window is
    keyed by bucket, so no task sees more than bucket_rows + n - 1 rows."""
    bucket_rows = max(bucket_rows, n)  # the halo must fit inside one previous bucket
    pos = positions(df, [order_col], name="_p")
    b = F.floor(F.col("_p") / bucket_rows).cast("long")
    own = pos.withColumn("_b", b).withColumn("_halo", F.lit(False))
    tail = (pos.filter(F.col("_p") % bucket_rows >= bucket_rows - (n - 1))
               .withColumn("_b", b + 1).withColumn("_halo", F.lit(True)))
    both = own.unionByName(tail)
    w = Window.partitionBy("_b").orderBy("_p").rowsBetween(-(n - 1), 0)
    res = both.withColumn(out, F.avg(value).over(w)).filter(~F.col("_halo"))
    return res.drop("_p", "_b", "_halo")


def with_next(df: DataFrame, episode: str, step: str, cols: Sequence[str], prefix: str = "next_") -> DataFrame:
    """Columns of the following step (NULL at the last step) by an equi-join on
    (episode, step + 1): a unique key, so no episode lands in a single task."""
    nxt = df.select(episode, (F.col(step) - 1).alias(step), *[F.col(c).alias(prefix + c) for c in cols],
                    F.lit(True).alias("_has_next"))
    j = df.join(nxt, [episode, step], "left")
    return j.withColumn("done", F.when(F.col("_has_next").isNull(), 1).otherwise(0)).drop("_has_next")


def td_target(df: DataFrame, reward: str, next_value: Column, gamma: float = 0.99, done: str = "done",
              out: str = "td_target") -> DataFrame:
    """R + gamma * V(next) * (1 - done); ``next_value`` is any expression over the
    next-step columns (a value, array_max of action values, least of two critics)."""
    v = F.coalesce(next_value, F.lit(0.0))
    return df.withColumn(out, F.col(reward) + F.lit(gamma) * v * (1 - F.col(done)))


def advantage(df: DataFrame, ret: str, value: str, out: str = "advantage") -> DataFrame:
    """G - V(state)."""
    return df.withColumn(out, F.col(ret) - F.col(value))


def recent_sample(df: DataFrame, ts: str, key: str, last_n: int, k: int, seed: int = 0) -> DataFrame:
    """The latest ``last_n`` transitions (a bounded buffer), then a random ``k`` of them."""
    recent = df.orderBy(F.desc(ts), F.desc(key)).limit(last_n)
    return recent.orderBy(hash_number(key, seed), key).limit(k)


def rows_to_arrays(df: DataFrame, episode: str, step: str, cols: Sequence[str], batch: int = 32) -> DataFrame:
    """Consecutive rows -> one array per field, in step order, per batch of ``batch``
    steps of an episode (each group is bounded by ``batch``)."""
    b = F.floor(F.col(step) / batch).cast("long").alias("batch")
    g = df.groupBy(episode, b).agg(F.array_sort(F.collect_list(F.struct(step, *cols))).alias("_rows"))
    return g.select(episode, "batch", *[F.col("_rows")[c].alias(c) for c in [step, *cols]])
