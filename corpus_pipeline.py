"""Corpus preparation: toxic, letterless, repeated and benchmark-leaking documents go, the rest is tokenized.

Each stage takes (spark, docs, sf_dir) and works on all rows of ``docs``; ``run`` writes what a stage keeps as
Parquet into the shared folder and reads it again as the next stage's ``docs``. All stages but the last return the
columns they were given, extra ones included. Null and empty texts: never toxic or leaking, dropped as letterless.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kiln.llm.bpe import bpe_digests, tokenizer_path
from kiln.llm.common import id_bucket, ready
from kiln.llm.decontaminate import drop_leaking
from kiln.llm.langid import drop_undetermined, fit_prototypes
from kiln.llm.neardup import near_duplicates, rows_not_named
from kiln.llm.toxicity import drop_toxic, toxicity_model
from kiln.session import staged
from kiln.sources.tables import table


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: rejects documents with a score of 0.7 or more."""
    ready(spark)
    return drop_toxic(docs, toxicity_model(spark, docs, sf_dir))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: rejects documents without a language, that is without any letter."""
    ready(spark)
    return drop_undetermined(docs, fit_prototypes(docs.where(id_bucket("doc_id", 4) != 2)))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: one document (the smallest id) of each group at five words and similarity 0.8 stays."""
    ready(spark)
    gone = near_duplicates(docs, words=5, percent=80).where("not kept").select(F.col("doc_id").alias("id")).distinct()
    return rows_not_named(docs, staged(gone, "copies"), "doc_id")


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: rejects documents that hold a benchmark item."""
    ready(spark)
    return drop_leaking(docs, table(spark, sf_dir, "benchmark"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: token ids and the text decoded from them, as digests."""
    ready(spark)
    return bpe_digests(docs, tokenizer_path())


STAGES = [("toxicity", toxicity), ("language", language), ("near_dedup", near_dedup),
          ("decontaminate", decontaminate), ("tokenize", tokenize)]

# Scores, sketches and token ids have no SQL form; tests hold the rows against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    ready(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
