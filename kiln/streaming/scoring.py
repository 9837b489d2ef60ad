"""Incremental scoring of newly arriving files with fitted preparation steps.

Every ``apply`` of a fitted operator (fills, recodes, bins, one-hot, scalers,
z-scores, log transforms) and every MLlib model ``transform`` is a narrow
per-row projection, so the same fitted objects that prepared the batch tables
run unchanged on a streaming DataFrame: fit once on the labelled table, then
score each new file as it lands (the reference's final "predict the unlabelled
table" step, done continuously). Exactly-once output comes from the query's
checkpoint folder plus the file sink; the sink folder is a shared path.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

Step = Callable[[DataFrame], DataFrame]


def stream_files(spark: SparkSession, folder: str, schema: StructType, fmt: str = "parquet",
                 glob: str | None = None, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming scan of a folder (schema given up front, as streams require);
    ``glob`` keeps only matching file names."""
    reader = spark.readStream.schema(schema).format(fmt)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(folder)


def prepare(df: DataFrame, steps: Sequence[Step]) -> DataFrame:
    """Chain fitted steps (each DataFrame -> DataFrame) on a batch or streaming frame."""
    return reduce(lambda d, f: f(d), steps, df)


def score_stream(stream: DataFrame, steps: Sequence[Step], select: Sequence[str], sink_path: str,
                 checkpoint_path: str, fmt: str = "parquet", trigger_once: bool = False) -> StreamingQuery:
    """Start a query that prepares and scores each micro-batch and appends the
    selected columns (e.g. id + prediction) to ``sink_path``."""
    out = prepare(stream, steps).select(*select)
    writer = (out.writeStream.format(fmt).outputMode("append")
              .option("checkpointLocation", checkpoint_path).option("path", sink_path))
    if trigger_once:
        writer = writer.trigger(availableNow=True)
    return writer.start()
