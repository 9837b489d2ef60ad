"""Common model plumbing: feature assembly, fitted-model wrapper, probability column."""

from __future__ import annotations

import gc
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.session import ensure_checkpoint_dir, staged


def assembler(features: Sequence[str], out: str = "features") -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol=out, handleInvalid="keep")


# Fits that visit fewer rows than this in all (rows times trees) keep the partitions of their table.
FEW_VISITS = 1_500_000
# Training rows that a task of a tree fit takes at most.
TREE_TASK_ROWS = 4_000_000
# Rows times trees of a forest that are fitted at once: full trees have about as many nodes as rows, and the driver holds
# them all until the fit ends, and again while it scores.
FOREST_VISITS = 10_000_000


def tree_rows(df: DataFrame, trees: int, rows: int | None = None) -> DataFrame:
    """``df``, best a cached one, dealt evenly to as many partitions as cores or ``TREE_TASK_ROWS`` ask for.

    A tree fit reads its table once a level and tree or group of nodes. In few or uneven partitions these passes
    leave cores idle; in many, every task sends the statistics of all open nodes, so that this traffic grows with
    the partitions.
    """
    rows = df.count() if rows is None else rows
    if rows * trees < FEW_VISITS:
        return df
    return df.repartition(max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // TREE_TASK_ROWS)))


@dataclass
class SparkModel:
    """A fitted MLlib pipeline (assembler + estimator) with a uniform output:
    ``prediction`` (double) and, for binary classifiers, ``p1`` = P(class 1)."""
    model: PipelineModel
    features: tuple
    label: str
    binary: bool = False

    def transform(self, df: DataFrame) -> DataFrame:
        out = self.model.transform(df)
        if self.binary and "probability" in out.columns:
            out = out.withColumn("p1", vector_to_array("probability")[1])
        drop = [c for c in ("features", "rawPrediction", "probability") if c in out.columns]
        return out.drop(*drop)

    def save(self, path: str) -> str:
        self.model.write().overwrite().save(path)
        return path

    def importances(self) -> list[float]:
        """Of the features, by the trees."""
        return self.model.stages[-1].featureImportances.toArray().tolist()


@dataclass
class ForestParts:
    """A forest whose trees were fitted and are kept in parts, so that the driver holds one part at a time. A row's votes are
    added up over the parts; otherwise the output is that of a :class:`SparkModel`."""
    paths: list[str]
    trees: list[int]
    shares: list[list[float]]  # importances by part
    features: tuple

    def transform(self, df: DataFrame) -> DataFrame:
        scored = df.withColumn("_votes", F.lit(None).cast("array<double>"))
        for k, path in enumerate(self.paths):
            model = PipelineModel.load(path)
            one = model.transform(scored).withColumn("_one", vector_to_array("rawPrediction"))
            both = F.when(F.col("_votes").isNull(), F.col("_one")).otherwise(F.zip_with("_votes", "_one", lambda a, b: a + b))
            scored = one.withColumn("_votes", both).select(*df.columns, "_votes")
            if k + 1 < len(self.paths):
                scored = staged(scored, "votes")  # one part's trees at a time
                del model, one
                gc.collect()
        votes = F.col("_votes")
        total = F.aggregate(votes, F.lit(0.0), lambda a, x: a + x)
        return scored.withColumns({"prediction": (F.array_position(votes, F.array_max(votes)) - 1).cast("double"),
                                   "p1": votes[1] / total}).drop("_votes")

    def save(self, path: str) -> str:
        for k, part in enumerate(self.paths):
            PipelineModel.load(part).write().overwrite().save(f"{path}/part-{k}")
        return path

    def importances(self) -> list[float]:
        share = np.average(np.array(self.shares), axis=0, weights=self.trees)
        return (share / max(share.sum(), 1e-300)).tolist()


def fit_forest_parts(spark, fit: Callable[[int, int], SparkModel], n_trees: int, most: int, seed: int) -> ForestParts:
    """``fit(trees, seed)`` for ``n_trees`` trees in all, in even parts of at most ``most``, each written once fitted."""
    most = -(-n_trees // -(-n_trees // most))
    out = ForestParts([], [], [], ())
    for k, start in enumerate(range(0, n_trees, most)):
        trees = min(most, n_trees - start)
        model = fit(trees, seed + 1_000_003 * k)
        out.paths.append(model.save(f"{ensure_checkpoint_dir(spark).rstrip('/')}/forest-{uuid.uuid4().hex}"))
        out.trees.append(trees)
        out.shares.append(model.importances())
        out.features = model.features
        del model
        gc.collect()
    return out


def fit_pipeline(df: DataFrame, features: Sequence[str], label: str, estimator, binary: bool = False,
                 extra_stages: Sequence = ()) -> SparkModel:
    pipe = Pipeline(stages=[*extra_stages, assembler(features), estimator])
    data = df.withColumn(label, F.col(label).cast("double"))
    return SparkModel(pipe.fit(data), tuple(features), label, binary)


def load_spark_model(path: str, features: Sequence[str], label: str, binary: bool = False) -> SparkModel:
    return SparkModel(PipelineModel.load(path), tuple(features), label, binary)
