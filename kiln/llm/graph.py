"""Connected components of a link table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.session import staged


def _towards_least(links: DataFrame, key: str, other: str) -> DataFrame:
    """Each link with the least neighbour of its ``key`` (the key itself included) as ``m``.

    The least neighbours are written first, so that the join back is a plain one whose hot keys
    (hubs) adaptive execution can split.
    """
    least = staged(links.groupBy(key).agg(F.least(F.min(other), F.col(key)).alias("m")), "least")
    return links.join(least, key)


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, component): the smallest node reachable, for every node that a link (a, b) names."""
    e = staged(links.where("a is not null and b is not null and a <> b")
               .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    state = None
    for _ in range(rounds):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _towards_least(both, "u", "v").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = staged(large.distinct(), "large")
        # Each u now points to smaller nodes only; all of them, and u, go to the least.
        small = _towards_least(e, "u", "v")
        e = staged(small.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
                   .unionByName(small.select("u", F.col("m").alias("v"))).distinct(), "small")
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    else:
        raise RuntimeError("components did not settle")
    return (e.select(F.col("u").alias("node"), F.col("v").alias("component"))
            .unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()))
