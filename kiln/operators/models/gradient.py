"""Batch gradient descent where MLlib has no matching loss.

Dense linear models and networks: each Arrow batch computes its numpy gradient
on the executors (weights arrive as a broadcast variable), the partial gradients
are summed in Spark, and Adam updates the small vector on the driver. Rows are
written once as blocks of numbers, small enough for a core's cache, so that a
step neither converts nor copies them. Sparse text models: the weight vector is a (term, w) table; each
step joins it to the (doc, term, x) table, so neither the data nor the weights
pass through the driver.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from kiln.operators.models.kernel_basis import sum_arrays
from kiln.session import staged

CHECKPOINT_EVERY = 10
BLOCK_ROWS = 2048


# ------------------------------------------------------------------ dense ReLU network

@dataclass
class FittedNetwork:
    sizes: tuple
    params: np.ndarray

    def unpack(self):
        return _unpack(self.params, self.sizes)

    def predict_batch(self, x: np.ndarray) -> np.ndarray:
        h = x
        layers = self.unpack()
        for i, (wm, bv) in enumerate(layers):
            h = h @ wm + bv
            if i < len(layers) - 1:
                h = np.maximum(h, 0)
        return h[:, 0]

    def transform(self, df: DataFrame, x: Sequence[str], out: str = "prediction") -> DataFrame:
        net = self

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                xb = pdf[list(x)].to_numpy(dtype=float)
                yield pdf.assign(**{out: net.predict_batch(xb) if len(pdf) else np.zeros(0)})

        schema = StructType([*df.schema.fields, StructField(out, DoubleType())])
        return df.mapInPandas(run, schema)


def _unpack(p: np.ndarray, sizes: Sequence[int]):
    out, k = [], 0
    for a, b in zip(sizes[:-1], sizes[1:]):
        wm = p[k:k + a * b].reshape(a, b)
        k += a * b
        bv = p[k:k + b]
        k += b
        out.append((wm, bv))
    return out


def _grad(p: np.ndarray, sizes, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Sum over the batch of d(squared error)/d(params) by backpropagation."""
    layers = _unpack(p, sizes)
    acts, h = [x], x
    for i, (wm, bv) in enumerate(layers):
        h = h @ wm
        h += bv
        if i < len(layers) - 1:
            np.maximum(h, 0, out=h)
        acts.append(h)
    delta = 2.0 * (acts[-1][:, 0] - y)[:, None]
    grads = []
    for i in range(len(layers) - 1, -1, -1):
        wm, _ = layers[i]
        grads.append((acts[i].T @ delta, delta.sum(0)))
        if i:
            delta = delta @ wm.T
            delta *= acts[i] > 0
    flat = []
    for gw, gb in reversed(grads):
        flat += [gw.ravel(), gb]
    return np.concatenate(flat)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of double columns as matrices of at most ``BLOCK_ROWS`` rows; nulls become NaN."""
    for b in batches:
        v = np.column_stack([c.to_numpy(zero_copy_only=False).astype(np.float64) for c in b.columns])
        parts = [v[k:k + BLOCK_ROWS] for k in range(0, len(v), BLOCK_ROWS)]
        yield pa.RecordBatch.from_arrays([pa.array([len(m) for m in parts], pa.int64()),
                                          pa.array([m.tobytes() for m in parts], pa.binary())], ["rows", "numbers"])


def mlp_regressor(df: DataFrame, x: Sequence[str], y: str, hidden: Sequence[int] = (32, 32, 64, 32),
                  epochs: int = 100, lr: float = 1 / 1500, seed: int = 1) -> FittedNetwork:
    """ReLU network, mean squared error, full-batch Adam (no batch-norm/dropout)."""
    sizes = (len(x), *hidden, 1)
    rng = np.random.default_rng(seed)
    parts = []
    for a, b in zip(sizes[:-1], sizes[1:]):
        parts += [rng.normal(0, math.sqrt(2.0 / a), a * b), np.zeros(b)]
    p = np.concatenate(parts)
    cols = [*(F.col(c).cast("double").alias(f"_x{i}") for i, c in enumerate(x)), F.col(y).cast("double").alias("_y")]
    data = staged(df.select(*cols).mapInArrow(_blocks, "rows long, numbers binary"), "blocks")
    n = data.agg(F.sum("rows")).first()[0] or 0
    mom, vel = np.zeros_like(p), np.zeros_like(p)
    for t in range(1, epochs + 1):
        bp = data.sparkSession.sparkContext.broadcast(p)

        def add(b: pa.RecordBatch, bp=bp) -> np.ndarray:
            acc = np.zeros_like(bp.value)
            for block in b.column("numbers"):
                v = np.frombuffer(block.as_buffer()).reshape(-1, sizes[0] + 1)
                acc += _grad(bp.value, sizes, v[:, :-1], v[:, -1])
            return acc

        grad = sum_arrays(data.select("numbers"), add, len(p)) / n
        bp.unpersist()
        mom = 0.9 * mom + 0.1 * grad
        vel = 0.999 * vel + 0.001 * grad ** 2
        p = p - lr * (mom / (1 - 0.9 ** t)) / (np.sqrt(vel / (1 - 0.999 ** t)) + 1e-8)
    return FittedNetwork(sizes, p)
