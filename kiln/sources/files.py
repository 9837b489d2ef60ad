"""Sources and sinks: CSV in/out, submission tables, model persistence, batch visits."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from kiln.session import ensure_checkpoint_dir


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None,
             infer: bool = False, multi_line: bool = True) -> DataFrame:
    """Header CSV; quoted fields may hold commas, doubled quotes and line breaks; an empty
    field, quoted or not, is NULL; NaN in a float column is NULL.

    Give ``schema`` in production: inference costs an extra full pass over the files. A
    file with line breaks inside fields cannot be split, so large tables should come as
    many files (``write_csv`` writes one per partition); ``multi_line=False`` lets single
    large files be split where no field holds a line break.
    """
    reader = (spark.read.option("header", True).option("quote", '"').option("escape", '"')
              .option("mode", "FAILFAST").option("multiLine", multi_line))
    if schema is not None:
        reader = reader.schema(schema)
    elif infer:
        reader = reader.option("inferSchema", True)
    df = reader.csv(path)
    floats = [f.name for f in df.schema.fields if f.dataType.typeName() in ("double", "float")]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in floats}) if floats else df


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """Header CSV folder (one part file per partition), no index column."""
    (df.write.mode(mode).option("header", True).option("quote", '"').option("escape", '"')
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))
    return path


def scratch_path(spark: SparkSession, kind: str) -> str:
    """Fresh folder below the shared checkpoint folder (never a machine-local temp dir)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{kind}-{uuid.uuid4().hex}"


def submission(scored: DataFrame, id_col: str, pred_col: str, name: str | None = None,
               cast: str | None = None) -> DataFrame:
    """Two-column answer table (id, prediction). The id travels with the row, so no
    positional alignment is needed."""
    pred = F.col(pred_col)
    if cast:
        pred = pred.cast(cast)
    return scored.select(F.col(id_col), pred.alias(name or pred_col))


def save_model(model, path: str) -> str:
    """Persist any MLlib model / pipeline model (overwrite)."""
    model.write().overwrite().save(path)
    return path


def load_model(path: str):
    """Reload what ``save_model`` wrote; the stored metadata names the class."""
    from pyspark.ml.util import DefaultParamsReader

    meta = DefaultParamsReader.loadMetadata(path, _active_sc())
    module, _, cls = meta["class"].rpartition(".")
    module = module.replace("org.apache.spark.ml", "pyspark.ml")
    py_cls = getattr(__import__(module, fromlist=[cls]), cls)
    return py_cls.load(path)


def _active_sc():
    return SparkSession.getActiveSession().sparkContext


def literal_table(spark: SparkSession, rows: Sequence[Sequence], schema: StructType | str) -> DataFrame:
    """Small table from literal rows (model results, fixtures)."""
    return spark.createDataFrame(list(rows), schema=schema)


def map_batches(df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema: StructType | str,
                size: int = 1000) -> DataFrame:
    """Apply ``fn`` to consecutive chunks of exactly ``size`` rows of every partition
    (the last chunk of a partition may be shorter). Arrow-batched, runs on executors."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pending: list[pd.DataFrame] = []
        held = 0
        for pdf in batches:
            pending.append(pdf)
            held += len(pdf)
            while held >= size:
                block = pd.concat(pending, ignore_index=True)
                yield fn(block.iloc[:size].reset_index(drop=True))
                rest = block.iloc[size:]
                pending, held = ([rest] if len(rest) else []), len(rest)
        if held:
            yield fn(pd.concat(pending, ignore_index=True))

    return df.mapInPandas(run, schema=schema)
