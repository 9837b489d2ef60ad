"""k-nearest-neighbour classifier and regressor (M5, M21), exact, over the metric index of ``metric_index``.

No training table is broadcast or collected: pivots, bounded in number, and one summary row per cell reach the
driver. Small and large tables take the same path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.operators.models.metric_index import MetricIndex


def neighbours(train: DataFrame, query: DataFrame, vec: str, label: str, k: int, train_id: str,
               query_id: str, exclude_self: bool = False) -> DataFrame:
    """(query_id, nn) with nn = the k nearest training points as array<struct<dist, tid, label>>; ids and
    labels of any type. Training rows without id or vector take no part; without any, no query has neighbours."""
    tr = train.select(F.col(train_id).alias("tid"), F.col(label).alias("label"), F.col(vec).cast("array<double>").alias("v"))
    q = query.select(F.col(query_id).alias("qid"), F.col(vec).cast("array<double>").alias("v"))
    index = MetricIndex(tr, k, exclude_self)
    if not index.n:
        types = ", ".join(f"{n}: {tr.schema[n].dataType.simpleString()}" for n in ("tid", "label"))
        empty = F.array().cast(f"array<struct<dist: double, {types}>>")
        return q.select(F.col("qid").alias(query_id), empty.alias("nn"))
    return index.search(q).withColumnRenamed("qid", query_id)


def knn_classify(train: DataFrame, query: DataFrame, vec: str, label: str, k: int = 4, train_id: str = "id",
                 query_id: str = "id", exclude_self: bool = False) -> DataFrame:
    """M5: majority label of the k nearest (ties -> smallest label)."""
    nn = neighbours(train, query, vec, label, k, train_id, query_id, exclude_self)
    votes = nn.select(query_id, F.explode("nn.label").alias("_l")).groupBy(query_id, "_l").agg(
        F.count(F.lit(1)).alias("_c"))
    best = votes.groupBy(query_id).agg(F.min(F.struct((-F.col("_c")).alias("k"), F.col("_l").alias("l"))).alias("_m"))
    return best.select(query_id, F.col("_m.l").alias("prediction"))


def knn_regress(train: DataFrame, query: DataFrame, vec: str, label: str, k: int = 5, train_id: str = "id",
                query_id: str = "id", exclude_self: bool = False) -> DataFrame:
    """Mean label of the k nearest."""
    nn = neighbours(train, query, vec, label, k, train_id, query_id, exclude_self)
    total = F.aggregate("nn", F.lit(0.0), lambda acc, x: acc + x["label"].cast("double"))
    return nn.select(query_id, (total / F.size("nn")).alias("prediction"))
