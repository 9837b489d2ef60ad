"""Language identification with hyperdimensional profiles.

Every letter has a fixed random vector of +1 and -1. A letter trigram (word borders count as a
letter) is bound into one vector: the vectors of its letters, rotated by their place, multiplied.
A document is the bundle (sum) of its trigram vectors; a language prototype is the bundle of the
documents of that language, each scaled to weight one. A document goes to the prototype with the
largest cosine. What all prototypes share is subtracted from both sides first, so that the cosine
measures what tells languages apart.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kiln.llm.common import (hold_memory, id_bucket, keep_texts, mix64, ready, remembers, replace_columns, schema_plus,
                             slices, texts_of)

DIMS = 1024
SLICE_CHARS = 60_000
# Letters up to this code point have a vector of their own, later ones share the remaining slots.
OWN_LETTERS, SLOTS = 0x530, 2048
MAX_LANGUAGES = 1000
# Prototype sums that reach the driver per language.
PARTIAL_SUMS = 32
SEED = 20240229
UNDETERMINED = "und"

_tables: dict[str, np.ndarray] = {}
remembers("langid", _tables.clear)


def _letters() -> tuple[np.ndarray, np.ndarray]:
    """Slot of each code point (0: no letter), and the vectors of the slots rotated by place."""
    hold_memory("langid")
    if not _tables:
        cps = np.arange(0x110000, dtype=np.uint64)
        slot = (OWN_LETTERS + mix64(cps) % np.uint64(SLOTS - OWN_LETTERS)).astype(np.int64)
        slot[:OWN_LETTERS] = np.arange(OWN_LETTERS)
        letter = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
        _tables["slot"] = np.where(letter, slot, 0)
        bits = mix64(mix64(np.arange(SLOTS, dtype=np.uint64) + np.uint64(SEED))[:, None]
                     + np.arange(DIMS // 64, dtype=np.uint64)[None, :])
        signs = np.unpackbits(np.ascontiguousarray(bits).view(np.uint8), axis=1).astype(np.int8) * 2 - 1
        _tables["vectors"] = np.stack([np.roll(signs, k, axis=1) for k in (2, 1, 0)])
    return _tables["slot"], _tables["vectors"]


def trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (text position, trigram) pairs in order, with counts."""
    slot, _ = _letters()
    low = [f" {t.lower()} " for t in texts]
    codes = np.frombuffer("".join(low).encode("utf-32-le", "surrogatepass"), np.uint32)
    ids = slot[codes]
    doc = np.repeat(np.arange(len(low)), [len(t) for t in low])
    keep = (ids > 0) | np.append(ids[1:] > 0, False)  # one border before a word
    keep |= np.insert(ids[:-1] > 0, 0, False)  # and one after it
    keep[1:] &= ~((ids[1:] == 0) & (ids[:-1] == 0) & keep[:-1] & (doc[1:] == doc[:-1]))
    ids, doc = ids[keep], doc[keep]
    if len(ids) < 3:
        none = np.empty(0, np.int64)
        return none, none, none
    same = (doc[2:] == doc[:-2]) & (ids[1:-1] > 0)
    key = ((doc[2:] * SLOTS + ids[:-2]) * SLOTS + ids[1:-1]) * SLOTS + ids[2:]
    key = np.sort(key[same])
    first = np.flatnonzero(np.diff(key, prepend=-1))
    return key[first] // SLOTS**3, key[first] % SLOTS**3, np.diff(np.append(first, len(key)))


def gram_vectors(grams: np.ndarray) -> np.ndarray:
    """Bound vectors of trigrams, one row each."""
    _, v = _letters()
    return (v[0][grams // SLOTS**2] * v[1][grams // SLOTS % SLOTS] * v[2][grams % SLOTS]).astype(np.float32)


def document_vectors(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Bundles of all texts (rows), and how many trigrams each has."""
    doc, gram, count = trigrams(texts)
    uniq, at = np.unique(gram, return_inverse=True)
    weights = np.zeros((len(texts), len(uniq)), np.float32)
    weights[doc, at] = count
    return weights @ gram_vectors(uniq), np.bincount(doc, count, len(texts))


def fit_prototypes(docs: DataFrame, text: str = "text", lang: str = "lang") -> tuple[list[str], np.ndarray]:
    """Languages in order and their prototypes (rows), learned from all rows with a language.

    Rows without a language, text or letter teach nothing. More than ``MAX_LANGUAGES`` languages are refused:
    the prototypes travel to every task.
    """
    ready(docs.sparkSession)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for b in batches:
            texts, langs = texts_of(b, text), b.column(lang).to_pylist()
            for s, e in slices(texts, SLICE_CHARS):
                doc, gram, count = trigrams(texts[s:e])
                if not len(doc):
                    continue
                share = count / np.bincount(doc, count, e - s)[doc]
                names, which = np.unique(langs[s:e], return_inverse=True)
                uniq, at = np.unique(gram, return_inverse=True)
                weights = np.zeros((len(names), len(uniq)))
                np.add.at(weights, (which[doc], at), share)
                for name, v in zip(names.tolist(), weights @ gram_vectors(uniq)):
                    sums[name] = sums.get(name, 0) + v
        if sums:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(sums)), pa.array([v.tobytes() for v in sums.values()], pa.binary())], ["lang", "v"])

    def total(pdf):
        v = np.sum([np.frombuffer(x, np.float64) for x in sorted(pdf["v"])], axis=0)
        return pdf.head(1)[["lang"]].assign(v=[v.tobytes()])

    known = docs.select(F.col(text).alias(text), F.col(lang).alias(lang)).where(F.col(lang).isNotNull())
    parts = (known.mapInArrow(partial, "lang string, v binary")
             .groupBy("lang", F.pmod(F.xxhash64("v"), F.lit(PARTIAL_SUMS)).alias("part"))
             .applyInPandas(total, "lang string, v binary"))
    # At most PARTIAL_SUMS rows per language, and no more languages than may be broadcast.
    rows = parts.limit(MAX_LANGUAGES * PARTIAL_SUMS + 1).collect()
    langs = sorted({r["lang"] for r in rows})
    if len(langs) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    proto = np.zeros((len(langs), DIMS))
    for r in sorted(rows, key=lambda r: (r["lang"], bytes(r["v"]))):
        proto[langs.index(r["lang"])] += np.frombuffer(r["v"], np.float64)
    return langs, proto


class Profiles:
    """Prototypes prepared for comparison."""

    def __init__(self, langs: list[str], proto: np.ndarray):
        self.langs = langs
        unit = proto / np.maximum(np.linalg.norm(proto, axis=1, keepdims=True), 1e-12)
        self.common = unit.mean(0) if len(langs) > 1 else np.zeros(DIMS)
        own = unit - self.common
        self.proto = (own / np.maximum(np.linalg.norm(own, axis=1, keepdims=True), 1e-12)).astype(np.float32)
        self.common = self.common.astype(np.float32)

    def predict(self, texts: list[str]) -> tuple[list[str], list[float]]:
        """Language and cosine (0 to 1) of each text; no letter, or nothing learned: undetermined and 0."""
        langs, scores = [], []
        for s, e in slices(texts, SLICE_CHARS):
            v, n = document_vectors(texts[s:e])
            if not self.langs:
                langs += [UNDETERMINED] * (e - s)
                scores += [0.0] * (e - s)
                continue
            v = v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12) - self.common
            cos = (v @ self.proto.T) / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)
            best = cos.argmax(1)
            top = np.clip(cos[np.arange(e - s), best], 0, 1)
            langs += [self.langs[k] if m else UNDETERMINED for k, m in zip(best, n)]
            scores += [float(x) if m else 0.0 for x, m in zip(top, n)]
        return langs, scores


def identify(docs: DataFrame, model: tuple[list[str], np.ndarray], text: str = "text",
             drop: tuple[str, ...] = ()) -> DataFrame:
    """Add ``lang_pred`` and ``score``. Null and letterless texts are undetermined with score 0; equal cosines
    go to the first language in order. One narrow pass over whole texts."""
    spark = ready(docs.sparkSession)
    held = spark.sparkContext.broadcast(Profiles(*model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            langs, scores = held.value.predict(texts_of(b, text))
            yield replace_columns(b, drop, lang_pred=pa.array(langs, pa.string()), score=pa.array(scores, pa.float64()))

    return docs.mapInArrow(run, schema_plus(docs, drop, lang_pred=T.StringType(), score=T.DoubleType()))


def _determined(profiles: Profiles, texts: list[str]) -> list[bool]:
    if not profiles.langs:  # nothing learned: only letters can tell
        return [any(map(str.isalpha, t)) for t in texts]
    return [lang != UNDETERMINED for lang in profiles.predict(texts)[0]]


def drop_undetermined(docs: DataFrame, model: tuple[list[str], np.ndarray], text: str = "text") -> DataFrame:
    """The rows whose text has a language: those without any letter go, also if no language was learned."""
    held = ready(docs.sparkSession).sparkContext.broadcast(Profiles(*model))
    return keep_texts(docs, held, _determined, text)


def op1_language(spark, sf_dir: str) -> DataFrame:
    """Language of every document, learned from those outside the held-out quarter."""
    from kiln.sources.tables import table

    ready(spark)
    docs = table(spark, sf_dir, "documents").withColumn("held_out", id_bucket("doc_id", 4) == 2)
    model = fit_prototypes(docs.where("not held_out"))
    return (identify(docs.select("doc_id", "held_out", "text"), model, drop=("text",))
            .select("doc_id", "held_out", "lang_pred", "score"))
