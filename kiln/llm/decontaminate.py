"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming search, exact check.

Every benchmark item has a 64-bit SimHash of its words (each weighs its length). Documents are read
in windows of as many words as the items have; a window's fingerprint comes from running sums. Items
are indexed by four 16-bit blocks, each entered under all values within three bits: a fingerprint
within 15 bits of an item differs from it by three bits or fewer in one block at least, so the index
proposes every item within that radius. Proposed pairs are compared exactly: weighted Jaccard
similarity of the five-word shingles of window and item, a shingle weighing its letters.

A window that holds none of an item's shingles has similarity zero with it, so windows are only
fingerprinted around words where a document repeats a shingle of some item, in the sizes of these
items. Nothing that the exact check could accept is lost by that.

Items go in blocks of ``ITEM_BLOCK``, one pass over the documents each, so what is broadcast does not
grow with the tables.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.llm.common import distinct, keep_texts, mix64, ready, slices, texts_of
from kiln.llm.shingles import join_hashes, word_hashes

SHINGLE_WORDS = 5
THRESHOLD = 0.8
RADIUS, BLOCKS, BLOCK_BITS, BLOCK_RADIUS = 15, 4, 16, 3
ITEM_BLOCK = 2048
SLICE_CHARS = 400_000
FILTER_BITS = 22
# Windows fingerprinted at once.
WINDOWS = 1 << 15

_WORD = re.compile(r"\w+")


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def _hash(words: list[str]) -> np.ndarray:
    return word_hashes([w.encode("utf-8", "surrogatepass") for w in words])


def _signs(h: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Weighted +1 / -1 of every bit of every word."""
    bits = np.unpackbits(np.ascontiguousarray(mix64(h)).view(np.uint8).reshape(len(h), 8), axis=1).astype(np.int32)
    return (2 * bits - 1) * weight[:, None].astype(np.int32)


def _pack(sums: np.ndarray) -> np.ndarray:
    """Fingerprints (uint64) of bit sums."""
    return np.packbits(sums > 0, axis=1).view(np.uint64).ravel()


class Shingled:
    """Word hashes, letters and shingles of a text."""

    def __init__(self, words: list[str], h: np.ndarray | None = None):
        self.h = _hash(words) if h is None else h
        self.size = np.fromiter(map(len, words), np.int64, len(words))

    def shingles(self, start: int, end: int) -> tuple[np.ndarray, np.ndarray]:
        """Distinct shingles (sorted) and weights of a range of words; short ranges are one shingle."""
        k = min(SHINGLE_WORDS, end - start)
        s = join_hashes(self.h[start:end], k)
        total = np.concatenate([[0], np.cumsum(self.size[start:end])])
        s, first = np.unique(s, return_index=True)
        return s, (total[k:] - total[:-k])[first]


class ItemIndex:
    """Search structures of a block of items: (item id, text) pairs."""

    def __init__(self, items: list[tuple[int | None, str]]):
        items = [(i, w) for i, w in ((i, words_of(t or "")) for i, t in items) if w]
        self.ids = [i for i, _ in items]
        texts = [Shingled(w) for _, w in items]
        self.sets = [t.shingles(0, len(t.h)) for t in texts]
        self.words = np.array([len(t.h) for t in texts], np.int64)
        self.prints = np.concatenate([_pack(_signs(t.h, t.size).sum(0, keepdims=True)) for t in texts]) \
            if texts else np.empty(0, np.uint64)
        # Shingle -> items, by shingle length (items shorter than five words are one shingle).
        self.anchors: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        for k in sorted({min(SHINGLE_WORDS, n) for n in self.words.tolist()}):
            pairs = [(s, i) for i, (ss, _) in enumerate(self.sets) if min(SHINGLE_WORDS, self.words[i]) == k for s in ss]
            key = np.array([s for s, _ in pairs], np.uint64)
            order = np.argsort(key, kind="stable")
            seen = np.zeros(1 << FILTER_BITS, bool)
            seen[key >> np.uint64(64 - FILTER_BITS)] = True
            self.anchors[k] = (key[order], np.array([i for _, i in pairs], np.int64)[order], seen)
        near = np.array([sum(1 << b for b in flips) for r in range(BLOCK_RADIUS + 1)
                         for flips in itertools.combinations(range(BLOCK_BITS), r)], np.uint64)
        self.blocks = []
        for b in range(BLOCKS):
            value = (self.prints >> np.uint64(b * BLOCK_BITS)) & np.uint64((1 << BLOCK_BITS) - 1)
            entry = (value[:, None] ^ near[None, :]).ravel().astype(np.int64)
            item = np.repeat(np.arange(len(self.prints)), len(near))
            order = np.argsort(entry, kind="stable")
            starts = np.searchsorted(entry[order], np.arange((1 << BLOCK_BITS) + 1))
            self.blocks.append((starts, item[order].astype(np.int32)))

    def within_radius(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All (window, item, distance) with a distance of ``RADIUS`` at most."""
        pairs = []
        for b, (starts, item) in enumerate(self.blocks):
            v = ((prints >> np.uint64(b * BLOCK_BITS)) & np.uint64((1 << BLOCK_BITS) - 1)).astype(np.int64)
            n = starts[v + 1] - starts[v]
            w = np.repeat(np.arange(len(prints)), n)
            at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(starts[v], n)
            pairs.append(w * len(self.prints) + item[at])
        pair = distinct(np.concatenate(pairs))
        w, i = pair // max(len(self.prints), 1), pair % max(len(self.prints), 1)
        d = np.bitwise_count(prints[w] ^ self.prints[i])
        ok = d <= RADIUS
        return w[ok], i[ok], d[ok]

    def _anchored(self, h: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(word position, item) where a text repeats a shingle of the item."""
        at, items = [], []
        for k, (key, item, seen) in self.anchors.items():
            if len(h) < k:
                continue
            s = join_hashes(h, k)
            p = np.flatnonzero(seen[s >> np.uint64(64 - FILTER_BITS)] & (doc[k - 1:] == doc[:len(s)]))
            lo, hi = np.searchsorted(key, s[p], "left"), np.searchsorted(key, s[p], "right")
            n = hi - lo
            at.append(np.repeat(p, n))
            items.append(item[np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)])
        none = np.empty(0, np.int64)
        return np.concatenate(at or [none]), np.concatenate(items or [none])

    def _search_text(self, text: Shingled, at: np.ndarray, items: np.ndarray) -> list[tuple[int, float, int, int]]:
        """(item, similarity, start, words) of one text with anchors at word positions ``at``."""
        n = len(text.h)
        best: dict[int, tuple[float, int, int]] = {}
        lo = max(0, int(at.min()) - int(self.words[items].max()))
        hi = min(n, int(at.max()) + int(self.words[items].max()) + SHINGLE_WORDS)
        for size in np.unique(self.words[items]).tolist():
            own = np.unique(at[self.words[items] == size])
            width = min(size, n)
            reach = np.arange(-width + 1, 1)
            starts = distinct(np.clip((own[:, None] + reach[None, :]).ravel(), 0, n - width))
            for c in range(0, len(starts), WINDOWS):
                part = starts[c:c + WINDOWS]
                first, last = int(part[0]), int(part[-1]) + width
                sums = np.concatenate([np.zeros((1, 64), np.int32),
                                       np.cumsum(_signs(text.h[first:last], text.size[first:last]), axis=0)])
                prints = _pack(sums[part - first + width] - sums[part - first])
                w, i, d = self.within_radius(prints)
                fits = self.words[i] == size
                w, i, d = w[fits], i[fits], d[fits]
                for k in np.lexsort((part[w], d, i)):
                    item, start = int(i[k]), int(part[w[k]])
                    if best.get(item, (0.0, 0, 0))[0] == 1.0:
                        continue
                    similar = self._similar(text, start, start + width, item)
                    if similar > best.get(item, (0.0, 0, 0))[0]:
                        best[item] = (similar, start, width)
        return [(i, *best[i]) for i in sorted(best) if best[i][0] >= THRESHOLD]

    def _similar(self, text: Shingled, start: int, end: int, item: int) -> float:
        s, w = text.shingles(start, end)
        t, v = self.sets[item]
        _, x, _ = np.intersect1d(s, t, assume_unique=True, return_indices=True)
        common = int(w[x].sum())
        return common / (int(w.sum()) + int(v.sum()) - common)

    def matches(self, texts: list[str]) -> list[tuple[int, int, float, int, int]]:
        """(text position, item position, similarity, start word, words) of all matches."""
        out = []
        if not self.ids:
            return out
        for s, e in slices(texts, SLICE_CHARS):
            words = [words_of(t) for t in texts[s:e]]
            n = np.array([len(w) for w in words])
            h = word_hashes([w.encode("utf-8", "surrogatepass") for ws in words for w in ws])
            doc, offset = np.repeat(np.arange(e - s), n), np.cumsum(n) - n
            at, items = self._anchored(h, doc)
            for k in np.unique(doc[at]).tolist():
                mine = doc[at] == k
                text = Shingled(words[k], h[offset[k]:offset[k] + n[k]])
                out += [(s + k, *m) for m in self._search_text(text, at[mine] - offset[k], items[mine])]
        return out


def item_blocks(benchmark: DataFrame, item_id: str = "item_id", text: str = "text") -> Iterator[list]:
    """Distinct items in blocks of about ``ITEM_BLOCK`` rows, each small enough to broadcast."""
    items = benchmark.select(F.col(item_id).alias("i"), F.col(text).alias("t")).where("t is not null").distinct()
    parts = -(-items.count() // ITEM_BLOCK)
    for p in range(parts):
        rows = items.where(F.pmod(F.xxhash64("i", "t"), F.lit(parts)) == p).orderBy("i", "t").collect()
        yield [(r["i"], r["t"]) for r in rows]


def find_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, item_id, similarity, start_word, n_words): the best window of each document and item whose
    similarity is ``THRESHOLD`` or more.

    Null and empty texts and items match nothing; null ids are reported as null; a repeated document row
    reports its matches again, a repeated item row does not. Documents shorter than an item are one window.
    """
    spark = ready(docs.sparkSession)
    schema = "doc_id long, item_id long, similarity double, start_word int, n_words int"
    found = spark.createDataFrame([], schema)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).alias("text"))
    for block in item_blocks(benchmark):
        held = spark.sparkContext.broadcast(ItemIndex(block))

        def run(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            index = held.value
            for b in batches:
                m = index.matches(texts_of(b, "text"))
                ids = b.column("doc_id").to_pylist()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([ids[x[0]] for x in m], pa.int64()), pa.array([index.ids[x[1]] for x in m], pa.int64()),
                     pa.array([x[2] for x in m], pa.float64()), pa.array([x[3] for x in m], pa.int32()),
                     pa.array([x[4] for x in m], pa.int32())],
                    ["doc_id", "item_id", "similarity", "start_word", "n_words"])

        found = found.unionByName(rows.mapInArrow(run, schema))
    return found


def _unmatched(index: ItemIndex, texts: list[str]) -> list[bool]:
    bad = {x[0] for x in index.matches(texts)}
    return [i not in bad for i in range(len(texts))]


def drop_leaking(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that match no item, all columns as they are; one narrow pass per block of items."""
    spark = ready(docs.sparkSession)
    for block in item_blocks(benchmark):
        docs = keep_texts(docs, spark.sparkContext.broadcast(ItemIndex(block)), _unmatched, text)
    return docs


def op7_decontaminate(spark, sf_dir: str) -> DataFrame:
    """Matches of every document with every benchmark item."""
    from kiln.sources.tables import table

    ready(spark)
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
