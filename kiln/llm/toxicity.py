"""Toxicity scores: logistic regression by FTRL-proximal over hashed word n-grams and skip-grams.

Features of a text are the distinct hashes of its words, of their first four and five letters (so
that unseen forms of a word count too), of word pairs, and of pairs with one and with two words
between them; each counts once. Training follows FTRL-proximal: every coordinate has its
own learning rate, which falls with the gradients it has seen, and L1 keeps weights at exactly zero
until their gradients add up, so the result is a short list of weights that is broadcast.

Labelled rows are trained in independent shards of about ``SHARD_ROWS`` rows whose weights are averaged;
a weight that no majority of the shards holds is dropped as chance.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kiln.llm.common import (distinct, hold_memory, id_bucket, keep_texts, mix64, ready, remembers, replace_columns,
                             schema_plus, slices, texts_of)

HASH_BITS = 20
TOXIC = 0.7
SLICE_CHARS = 400_000
SHARD_ROWS = 6_000
# Bound of the labelled rows that are fitted; more are thinned by a hash of the id.
TRAIN_ROWS = 24_000
EPOCHS = 3
ALPHA, BETA, L1, L2 = 0.1, 1.0, 6.0, 1.0
REFIT_ALPHA, REFIT_EPOCHS, REFIT_L2, MOST_WEIGHT = 1.0, 30, 0.01, 10.0
KNOWN_WORDS = 300_000
STEMS = (4, 5)

_WORD = re.compile(r"\w+")


class WordHashes(dict):
    """Number of each word met, and the 64-bit hashes of the word and its stems by that number."""

    def __init__(self):
        super().__init__()
        self.hashes = [array("Q") for _ in range(1 + len(STEMS))]

    def __missing__(self, word: str) -> int:
        n = self[word] = len(self)
        self.hashes[0].append(xxhash.xxh64_intdigest(word))
        for length, known in zip(STEMS, self.hashes[1:]):
            known.append(xxhash.xxh64_intdigest(word[:length], seed=length))
        return n

    def forget(self) -> None:
        self.clear()
        self.hashes = [array("Q") for _ in self.hashes]

    def of(self, words: list[list[str]], total: int) -> list[np.ndarray]:
        """Hashes of all words in order: whole words, then each stem length."""
        if len(self) > KNOWN_WORDS:
            self.forget()
        at = np.fromiter((x for w in words for x in map(self.__getitem__, w)), np.int64, total)
        return [np.array(known, np.uint64)[at] if total else np.empty(0, np.uint64) for known in self.hashes]


_hashes = WordHashes()
remembers("toxicity", _hashes.forget)


def features(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(text position, hashed feature) of every occurrence, in no order."""
    hold_memory("toxicity")
    words = [_WORD.findall(t.lower()) for t in texts]
    n = [len(w) for w in words]
    h, *stems = _hashes.of(words, sum(n))
    doc = np.repeat(np.arange(len(texts)), n)
    docs, keys = [doc] * (1 + len(stems)), [mix64(x) for x in (h, *stems)]
    for gap in (1, 2, 3):
        same = doc[gap:] == doc[:-gap]
        pair = h[:-gap] * np.uint64(0x9E3779B97F4A7C15) + h[gap:] + np.uint64(gap)
        docs.append(doc[gap:][same])
        keys.append(mix64(pair[same]))
    return np.concatenate(docs), (np.concatenate(keys) >> np.uint64(64 - HASH_BITS)).astype(np.int64)


def ftrl(rows: list[tuple[np.ndarray, int]], epochs: int = EPOCHS, l1: float = L1,
         l2: float = L2, alpha: float = ALPHA, weight: float = 1.0) -> tuple[np.ndarray, float]:
    """Weights and bias after passes over (distinct features, label) rows in the given order.

    weight: how often a positive row counts.
    """
    size = 1 << HASH_BITS
    z, n = np.zeros(size + 1), np.zeros(size + 1)
    positive = sum(y for _, y in rows)
    rate = positive * weight / max(len(rows) + positive * (weight - 1), 1)
    rate = min(max(rate, 1e-3), 1 - 1e-3)
    base = float(np.log(rate / (1 - rate)))

    def weights(at):
        zi = z[at]
        w = -(zi - np.sign(zi) * l1) / ((BETA + np.sqrt(n[at])) / alpha + l2)
        return np.where(np.abs(zi) <= l1, 0.0, w)

    for _ in range(epochs):
        for at, y in rows:
            at = np.append(at, size)  # the last coordinate corrects the bias
            w = weights(at)
            g = 1 / (1 + np.exp(-np.clip(base + w.sum(), -35, 35))) - y
            g = g * weight if y else g
            root = np.sqrt(n[at] + g * g)
            z[at] += g - (root - np.sqrt(n[at])) / alpha * w
            n[at] += g * g
    w = weights(np.arange(size + 1))
    return w[:size], base + float(w[size])


def ftrl_refitted(rows: list[tuple[np.ndarray, int]]) -> tuple[np.ndarray, float]:
    """L1 chooses the coordinates; a second run over these alone, without L1 and with both classes
    weighing the same (by a factor of ``MOST_WEIGHT`` at most), undoes its shrinking."""
    chosen = ftrl(rows)[0] != 0
    positive = sum(y for _, y in rows)
    weight = min(max((len(rows) - positive) / max(positive, 1), 1.0), MOST_WEIGHT)
    return ftrl([(at[chosen[at]], y) for at, y in rows], REFIT_EPOCHS, 0.0, REFIT_L2, REFIT_ALPHA, weight)


def fit_toxicity(labelled: DataFrame, text: str = "text", label: str = "label", order: str = "doc_id",
                 shards: int = 1) -> tuple[np.ndarray, np.ndarray, float]:
    """(feature numbers, weights, bias) from rows with a 0/1 label; rows with another label teach nothing.

    The rows are dealt to ``shards`` tasks; the caller bounds them (see ``bounded_sample``). No row at all
    gives an empty model whose score is 0.5 for every text.
    """
    ready(labelled.sparkSession)

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple[np.ndarray, int]] = []
        for b in batches:
            texts, ys = texts_of(b, "text"), b.column("label").to_pylist()
            for s, e in slices(texts, SLICE_CHARS):
                doc, feat = features(texts[s:e])
                key = distinct(doc << HASH_BITS | feat)
                cut = np.searchsorted(key, np.arange(e - s + 1) << HASH_BITS)
                rows += [((key[cut[i]:cut[i + 1]] & ((1 << HASH_BITS) - 1)).astype(np.int32), ys[s + i])
                         for i in range(e - s)]
        if rows:
            w, bias = ftrl_refitted(rows)
            at = np.flatnonzero(w)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.append(at, -1), pa.int32()), pa.array(np.append(w[at], bias))], ["feature", "w"])

    rows = (labelled.select(F.col(text).alias("text"), F.col(label).cast("int").alias("label"),
                            F.xxhash64(order).alias("h"), F.col(order).alias("k")).where("label in (0, 1)")
            .repartition(shards).sortWithinPartitions("h", "k", "text", "label"))
    parts = rows.select("text", "label").mapInArrow(train, "feature int, w double")
    w = (parts.groupBy("feature").agg(F.sum("w").alias("w"), F.count("*").alias("n"))).collect()  # 2^20 rows at most
    trained = max([r["n"] for r in w if r["feature"] == -1], default=0)
    bias = next((r["w"] / r["n"] for r in w if r["feature"] == -1), 0.0)
    kept = sorted((r["feature"], r["w"] / trained) for r in w if r["feature"] >= 0 and 2 * r["n"] > trained)
    return np.array([f for f, _ in kept], np.int64), np.array([x for _, x in kept], np.float32), bias


class ToxicityScorer:
    """Weights laid out for lookup."""

    def __init__(self, model: tuple[np.ndarray, np.ndarray, float]):
        at, weights, self.bias = model
        self.sparse = at, weights
        self.w: np.ndarray | None = None

    def __getstate__(self):
        return self.sparse, self.bias

    def __setstate__(self, state):
        self.sparse, self.bias = state
        self.w = None

    def scores(self, texts: list[str]) -> np.ndarray:
        if self.w is None:
            self.w = np.zeros(1 << HASH_BITS, np.float32)
            self.w[self.sparse[0]] = self.sparse[1]
        out = [np.empty(0)]
        for s, e in slices(texts, SLICE_CHARS):
            doc, feat = features(texts[s:e])
            hit = self.w[feat] != 0
            key = distinct(doc[hit] << HASH_BITS | feat[hit])
            margin = self.bias + np.bincount(key >> HASH_BITS, self.w[key & ((1 << HASH_BITS) - 1)], e - s)
            out.append(1 / (1 + np.exp(-np.clip(margin, -35, 35))))
        return np.concatenate(out)


def score_toxicity(docs: DataFrame, model: tuple[np.ndarray, np.ndarray, float], text: str = "text",
                   out: str = "score", drop: tuple[str, ...] = ()) -> DataFrame:
    """Add ``out``: the probability that the whole text is toxic; null and empty texts get the base rate."""
    held = ready(docs.sparkSession).sparkContext.broadcast(ToxicityScorer(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield replace_columns(b, drop, **{out: pa.array(held.value.scores(texts_of(b, text)), pa.float64())})

    return docs.mapInArrow(run, schema_plus(docs, drop, **{out: T.DoubleType()}))


def _clean(scorer: ToxicityScorer, texts: list[str]) -> list[bool]:
    return (scorer.scores(texts) < TOXIC).tolist()


def drop_toxic(docs: DataFrame, model: tuple[np.ndarray, np.ndarray, float], text: str = "text") -> DataFrame:
    """The rows whose score is below ``TOXIC``."""
    held = ready(docs.sparkSession).sparkContext.broadcast(ToxicityScorer(model))
    return keep_texts(docs, held, _clean, text)


def bounded_sample(docs: DataFrame, labels: DataFrame, bound: int = TRAIN_ROWS, id_col: str = "doc_id",
                   text: str = "text", label: str = "toxic") -> tuple[DataFrame, int]:
    """(doc_id, text, label) and their expected number: about ``bound`` labelled documents at most, chosen by a hash of the id.

    An id with several labels counts as toxic if one of them says so.
    """
    one = (labels.where(F.col(label).isin(0, 1)).groupBy(id_col).agg(F.max(label).alias("label")))
    n = one.count()
    if n > bound:
        one = one.where(F.pmod(F.xxhash64(id_col, F.lit("train")), F.lit(1 << 20)) < int((1 << 20) * bound / n))
    # The chosen labels are bounded by ``bound`` rows of an id and a number.
    return docs.select(id_col, F.col(text).alias("text")).join(F.broadcast(one), id_col), min(n, bound)


def toxicity_model(spark, docs: DataFrame, sf_dir: str):
    """Model from the labelled ``documents`` outside the held-out third."""
    from kiln.sources.tables import table

    labels = table(spark, sf_dir, "labels").where(id_bucket("doc_id", 3) != 1)
    sample, n = bounded_sample(docs, labels)
    return fit_toxicity(sample, shards=max(2, -(-n // SHARD_ROWS)))


def op5_toxicity(spark, sf_dir: str) -> DataFrame:
    """Toxicity score of every document."""
    from kiln.sources.tables import table

    ready(spark)
    docs = table(spark, sf_dir, "documents")
    scored = score_toxicity(docs.select("doc_id", "text"), toxicity_model(spark, docs, sf_dir), drop=("text",))
    return scored.select("doc_id", (id_bucket("doc_id", 3) == 1).alias("held_out"), "score",
                         (F.col("score") >= TOXIC).cast("int").alias("predicted"))
