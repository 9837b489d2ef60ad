"""Small helpers shared by the corpus operators."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kiln.session import prepare

# Rows an Arrow batch holds when documents are handed to Python: bounds a worker's memory.
BATCH_ROWS = 1024
BATCH_BYTES = 16 << 20

# Lower-casing of A-Z only, and runs of anything but blank and \t..\r.
ASCII_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def ready(spark: SparkSession) -> SparkSession:
    """Session defaults, shared folder, worker package and small Arrow batches."""
    prepare(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


# What Python workers remember between batches, by owner: the functions that forget it.
_forget: dict[str, Callable[[], None]] = {}
_owner = [""]


def remembers(owner: str, forget: Callable[[], None]) -> None:
    """Register a worker memory; it lasts until another owner's begins."""
    _forget[owner] = forget


def hold_memory(owner: str) -> None:
    """Workers live on between stages: one memory at a time, so a stage starts without what others left."""
    if _owner[0] != owner:
        for name, forget in _forget.items():
            if name != owner:
                forget()
        _owner[0] = owner
        give_back()


def give_back() -> None:
    """Return freed memory to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim:
        trim(0)


def schema_plus(df: DataFrame, drop: tuple[str, ...] = (), **new: T.DataType) -> T.StructType:
    """The schema of ``df`` without ``drop`` and the new names, followed by the new columns."""
    gone = {c.lower() for c in (*drop, *new)}
    fields = [f for f in df.schema.fields if f.name.lower() not in gone]
    return T.StructType(fields + [T.StructField(k, t) for k, t in new.items()])


def replace_columns(batch: pa.RecordBatch, drop: tuple[str, ...] = (), **new: pa.Array) -> pa.RecordBatch:
    """Arrow counterpart of :func:`schema_plus`."""
    gone = {c.lower() for c in (*drop, *new)}
    names = [n for n in batch.schema.names if n.lower() not in gone]
    return pa.RecordBatch.from_arrays([batch.column(n) for n in names] + list(new.values()), names + list(new))


def texts_of(batch: pa.RecordBatch, column: str) -> list[str]:
    """Python strings of a column; null counts as empty."""
    return [t if t is not None else "" for t in batch.column(column).to_pylist()]


def slices(texts: list[str], chars: int) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive texts of about ``chars`` characters, one text at least."""
    start, held = 0, 0
    for i, t in enumerate(texts):
        if held and held + len(t) > chars:
            yield start, i
            start, held = i, 0
        held += len(t)
    if start < len(texts):
        yield start, len(texts)


def id_bucket(id_col: str, n: int):
    """crc32 of the id as text, modulo n; a null id falls in bucket 0."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % n, F.lit(0))


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads 64-bit integers over all bits (fixed constants of splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def distinct(keys: np.ndarray) -> np.ndarray:
    """Sorted distinct values (by sorting: hash-based unique is slower on mostly distinct keys)."""
    if not len(keys):
        return keys
    keys = np.sort(keys)
    return keys[np.append(True, keys[1:] != keys[:-1])]


def keep_texts(docs: DataFrame, held, decide, text: str = "text") -> DataFrame:
    """The rows of ``docs`` for which ``decide(held.value, texts)`` says true, all columns as they are."""
    ready(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array(decide(held.value, texts_of(b, text)), pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
