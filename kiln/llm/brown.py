"""Language-model scores from Brown classes.

Model. The ``FREQUENT`` most frequent training words are clustered by the exchange algorithm: words
move one by one to the class that most increases the likelihood of a class bigram model, until
passes change little. Every other word that is met twice or more in training moves, in one round over
all of them, to the class with the largest exchange gain given the classes of the frequent words. The
end of a text, words met once, and words never seen are classes of their own. A token's probability is

    0.9 * P(class | class before) * P(word | class) + 0.1 * add-one unigram,

class transitions smoothed towards the class frequencies; P(word | class) is the word's share of its
class, and 1 / (V + 1) for an unseen word. Half of the mass of words seen once goes to unseen ones.

Job. Texts are packed into blocks (distinct word hashes, token codes). Each block sends its training
words with their counts to hash buckets, which name the frequent words. After these are clustered, each
block sends all its distinct words again, with the counts of the classes before and after them; a bucket
adds them up, chooses the classes, and sends totals and classes back, so that no task or broadcast holds
the vocabulary. Only the frequent words' bigram counts, a bounded matrix, and class totals reach the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.llm.common import give_back, id_bucket, ready, slices, texts_of
from kiln.llm.shingles import split_words, word_hashes
from kiln.session import staged

BLOCK_CHARS = 4_000_000
# Tokens scored or counted at a time.
TOKENS_AT_ONCE = 200_000
# Blocks whose words one bucket adds up: sets the number of buckets, so a bucket's size stays the same.
BUCKET_BLOCKS = 16
LEAST_BUCKETS = 64
FREQUENT, CLASSES, PASSES = 1024, 48, 6
WEIGHT = 0.9
TRANSITION_PRIOR = 5.0
SALT = 32
# Slots of a word's context: the class after it, the class before it, and the word itself after itself.
SLOTS = 2 * CLASSES + 1
# Context counts a bucket adds up at a time, and words whose gains are compared at a time.
CONTEXTS_AT_ONCE, WORDS_AT_ONCE = 1_000_000, 1024
UNCLUSTERED = 255
# The end of a text as a token; no word holds a blank.
END = np.uint64(xxhash.xxh64_intdigest(b" "))


def to_planes(x: np.ndarray) -> bytes:
    """Whole numbers as byte planes: small numbers leave planes of zeros, which compress to nothing."""
    return np.ascontiguousarray(x.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def from_planes(x: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(x, np.uint8).reshape(4, -1).T).view("<i4").ravel()


def wide_to_planes(x: np.ndarray) -> bytes:
    """As ``to_planes`` for numbers of up to 64 bits."""
    return np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8).T).tobytes()


def wide_from_planes(x: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(x, np.uint8).reshape(8, -1).T).view("<u8").ravel().astype(np.int64)


def each_row(batch: pa.RecordBatch) -> Iterator[dict]:
    """The rows of a batch one at a time: block rows are large, so no more than one is copied."""
    for i in range(batch.num_rows):
        yield batch.slice(i, 1).to_pylist()[0]
        give_back()


def pack_blocks(docs: DataFrame) -> DataFrame:
    """Blocks of (doc_id, held_out, text) rows: ids, flags, token numbers, distinct words by falling frequency,
    each token's place among them, training counts, training tokens."""
    ready(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        block = TaskContext.get().partitionId() << 32
        ids: list = []
        held: list = []
        n: list[int] = []
        hashes: list[np.ndarray] = []
        chars = 0

        def packed():
            words, codes = np.unique(np.concatenate(hashes), return_inverse=True)
            order = np.argsort(-np.bincount(codes), kind="stable")
            words, codes = words[order], np.argsort(order)[codes]
            trains = np.repeat(~np.array(held, bool), n)
            counts = np.bincount(codes[trains], minlength=len(words))
            row = [[block], [ids], [np.array(held, np.uint8).tobytes()], [np.array(n, np.int32).tobytes()],
                   [words.tobytes()], [to_planes(codes)], [to_planes(counts)], [int(trains.sum())]]
            types = [pa.int64(), pa.list_(pa.int64()), *[pa.binary()] * 5, pa.int64()]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(row, types)],
                ["block", "ids", "held", "n", "words", "codes", "counts", "train"])

        for b in batches:
            texts, doc_ids, flags = texts_of(b, "text"), b.column("doc_id").to_pylist(), b.column("held_out").to_pylist()
            for s, e in slices(texts, 1_000_000):
                for k in range(s, e):
                    h = np.append(word_hashes(split_words(texts[k])), END)
                    ids.append(doc_ids[k])
                    held.append(flags[k])
                    n.append(len(h))
                    hashes.append(h)
                    chars += len(texts[k]) + 1
                if chars >= BLOCK_CHARS:
                    yield packed()
                    block, chars = block + 1, 0
                    ids, held, n, hashes = [], [], [], []
        if ids:
            yield packed()
        ids, held, n, hashes = [], [], [], []
        give_back()

    return docs.mapInArrow(run, "block long, ids array<bigint>, held binary, n binary, words binary, codes binary, "
                                "counts binary, train long")


def _bucket_cuts(words: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket's words begin among sorted ones."""
    return np.searchsorted((words >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32), np.arange(buckets + 1))


def most_frequent(blocks: DataFrame, buckets: int) -> np.ndarray:
    """Sorted hashes of the ``FREQUENT`` most frequent training words."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in each_row(b):
                words, counts = np.frombuffer(row["words"], np.uint64), from_planes(row["counts"])
                words, counts = words[counts > 0], counts[counts > 0]
                order = np.argsort(words)
                words, counts = words[order], counts[order]
                cut = _bucket_cuts(words, buckets)
                some = np.flatnonzero(np.diff(cut))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(some, pa.int32()),
                     pa.array([words[cut[k]:cut[k + 1]].tobytes() for k in some], pa.binary()),
                     pa.array([to_planes(counts[cut[k]:cut[k + 1]]) for k in some], pa.binary())],
                    ["bucket", "words", "counts"])

    def top(pdf):
        import pandas as pd
        known, at = np.unique(np.concatenate([np.frombuffer(w, np.uint64) for w in pdf["words"]]), return_inverse=True)
        totals = np.bincount(at, np.concatenate([from_planes(c) for c in pdf["counts"]]), len(known)).astype(np.int64)
        first = np.lexsort((known, -totals))[:FREQUENT]
        return pd.DataFrame({"word": known[first].view(np.int64), "count": totals[first]})

    tops = (blocks.select("words", "counts").mapInArrow(split, "bucket int, words binary, counts binary")
            .groupBy("bucket").applyInPandas(top, "word long, count long"))
    chosen = [r["word"] for r in tops.orderBy(F.desc("count"), "word").limit(FREQUENT).collect()]
    return np.sort(np.array(chosen, np.int64).view(np.uint64))


def add_totals(blocks: DataFrame, buckets: int, frequent: np.ndarray, of: np.ndarray, g: np.ndarray) -> DataFrame:
    """(block, bucket, totals, classes, vocabulary): training counts and classes of each block's words by
    bucket, and the bucket's number of training words on one of its rows.

    of: classes of the ``frequent`` words and, at the end, of all others together; g: bigram counts of these classes.
    """
    rest = int(of[-1])

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in each_row(b):
                block, words, counts = row["block"], np.frombuffer(row["words"], np.uint64), from_planes(row["counts"])
                order = np.argsort(words)
                key, times = word_contexts(row, order, frequent, of)
                words, counts = words[order], counts[order]
                each = np.bincount(key // SLOTS, minlength=len(words)).astype(np.uint8)
                slot = (key % SLOTS).astype(np.uint8)
                cut = _bucket_cuts(words, buckets)
                at = np.searchsorted(key, cut * SLOTS)
                some = np.flatnonzero(np.diff(cut))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(some, pa.int32()), pa.array([block] * len(some), pa.int64()),
                     pa.array([words[cut[k]:cut[k + 1]].tobytes() for k in some], pa.binary()),
                     pa.array([to_planes(counts[cut[k]:cut[k + 1]]) for k in some], pa.binary()),
                     pa.array([each[cut[k]:cut[k + 1]].tobytes() for k in some], pa.binary()),
                     pa.array([slot[at[k]:at[k + 1]].tobytes() for k in some], pa.binary()),
                     pa.array([to_planes(times[at[k]:at[k + 1]]) for k in some], pa.binary())],
                    ["bucket", "block", "words", "counts", "each", "slots", "times"])

    def total(pdf):
        import pandas as pd
        words = [np.frombuffer(w, np.uint64) for w in pdf["words"]]
        known, at = np.unique(np.concatenate(words), return_inverse=True)
        totals = np.bincount(at, np.concatenate([from_planes(c) for c in pdf["counts"]]), len(known)).astype(np.int64)
        ends = np.cumsum([len(w) for w in words])
        at = np.split(at, ends[:-1])
        each = [np.frombuffer(e, np.uint8) for e in pdf["each"]]
        first = [np.append(0, np.cumsum(e, dtype=np.int64)) for e in each]
        slots = [np.frombuffer(x, np.uint8) for x in pdf["slots"]]
        parts = max(1, -(-sum(map(len, slots)) // CONTEXTS_AT_ONCE))
        classes = np.full(len(known), UNCLUSTERED, np.uint8)
        times = pdf["times"].tolist()
        for lo, hi in zip(*(lambda c: (c[:-1], c[1:]))(len(known) * np.arange(parts + 1) // parts)):
            keys, values = [], []
            for a, e, f, x, t in zip(at, each, first, slots, times):
                i, j = np.searchsorted(a, (lo, hi))
                keys.append(np.repeat(a[i:j] * SLOTS, e[i:j]) + x[f[i]:f[j]])
                values.append(np.frombuffer(t, np.uint8).reshape(4, -1)[:, f[i]:f[j]].T.copy().view("<u4").ravel())
            key, same = np.unique(np.concatenate(keys), return_inverse=True)
            value = np.bincount(same, np.concatenate(values), len(key))
            word, slot = key // SLOTS, key % SLOTS
            often = totals[word] > 1
            members, number = np.unique(word[often], return_inverse=True)
            classes[members] = best_classes(number, slot[often], value[often], g, rest)
        del keys, values, key, same, value, word, slot
        give_back()
        return pd.DataFrame({"block": pdf["block"].to_numpy(), "bucket": pdf["bucket"].to_numpy(),
                             "totals": [wide_to_planes(totals[a]) for a in at], "classes": [classes[a].tobytes() for a in at],
                             "vocabulary": [int((totals > 0).sum())] + [0] * (len(pdf) - 1)})

    return staged(blocks.select("block", "held", "n", "words", "codes", "counts").mapInArrow(
        split, "bucket int, block long, words binary, counts binary, each binary, slots binary, times binary")
        .groupBy("bucket").applyInPandas(
            total, "block long, bucket int, totals binary, classes binary, vocabulary long"), "totals")


def _block_arrays(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(held, tokens per text, codes) of a block row."""
    return np.frombuffer(row["held"], np.uint8).astype(bool), np.frombuffer(row["n"], np.int32), from_planes(row["codes"])


def _pairs_before(n: np.ndarray, codes: np.ndarray, end: int) -> np.ndarray:
    """The code before each token; before the first of a text stands the end."""
    before = np.empty(len(codes), np.int32)
    before[1:] = codes[:-1]
    before[np.cumsum(n) - n] = end
    return before


def _numbers(words: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    """Places of words among the sorted frequent ones; their number for all others."""
    if not len(frequent):
        return np.zeros(len(words), np.int64)
    at = np.minimum(np.searchsorted(frequent, words), len(frequent) - 1)
    return np.where(frequent[at] == words, at, len(frequent))


def word_contexts(row: dict, order: np.ndarray, frequent: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place * SLOTS + slot, times), ascending: classes after and before the other than frequent words of a
    block in its training texts; places are those in ``order``."""
    held, n, codes = _block_arrays(row)
    words = np.frombuffer(row["words"], np.uint64)
    number = _numbers(words, frequent)
    other, cls = number == len(frequent), of[number]
    train = np.repeat(~held, n)
    a, b = (x[train] for x in (_pairs_before(n, codes, int(np.flatnonzero(words == END)[0])), codes))
    del codes, train
    place = np.empty(len(words), np.int64)
    place[order] = np.arange(len(words))
    itself = a == b
    i, j = other[a] & ~itself, other[b] & ~itself
    both = itself & other[a]
    return np.unique(np.concatenate([place[a[i]] * SLOTS + cls[b[i]], place[b[j]] * SLOTS + CLASSES + cls[a[j]],
                                     place[a[both]] * SLOTS + SLOTS - 1]), return_counts=True)


def _sum_matrix(blocks: DataFrame, size: int, cells) -> np.ndarray:
    """Sum over blocks of ``cells(row)`` = (row, column) pairs of a bounded size x size count matrix."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        m = np.zeros(size * size, np.int64)
        for b in batches:
            for row in each_row(b):
                i, j = cells(row)
                for s in range(0, len(i), TOKENS_AT_ONCE):
                    pair = i[s:s + TOKENS_AT_ONCE].astype(np.int64) * size + j[s:s + TOKENS_AT_ONCE]
                    m += np.bincount(pair, minlength=size * size)
                del i, j
        m = m.reshape(size, size)
        rows = np.flatnonzero(m.any(1))
        if len(rows):
            part = TaskContext.get().partitionId() % SALT
            cols = [np.flatnonzero(m[r]) for r in rows]
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows, pa.int32()), pa.array([part] * len(rows), pa.int32()),
                 pa.array([c.astype(np.int32).tobytes() for c in cols], pa.binary()),
                 pa.array([m[r, c].tobytes() for r, c in zip(rows, cols)], pa.binary())], ["r", "part", "cols", "counts"])

    def add(pdf):
        v = np.zeros(size, np.int64)
        for c, n in zip(pdf["cols"], pdf["counts"]):
            v[np.frombuffer(c, np.int32)] += np.frombuffer(n, np.int64)
        c = np.flatnonzero(v)
        return pdf.head(1).assign(cols=[c.astype(np.int32).tobytes()], counts=[v[c].tobytes()])

    schema = "r int, part int, cols binary, counts binary"
    rows = (blocks.mapInArrow(partial, schema).groupBy("r", "part").applyInPandas(add, schema)
            .groupBy("r").applyInPandas(add, schema).collect())  # size rows at most
    out = np.zeros((size, size), np.int64)
    for r in rows:
        out[r["r"], np.frombuffer(r["cols"], np.int32)] = np.frombuffer(r["counts"], np.int64)
    return out


def _h(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-12))


def exchange_classes(c: np.ndarray, classes: int, passes: int = PASSES) -> np.ndarray:
    """Class of each word from its bigram counts c[before, after], by the exchange algorithm.

    The last word (everything that is not clustered) stays in the last class.
    """
    words = len(c)
    if words <= 1:
        return np.zeros(words, np.int64)
    classes = min(classes, words)
    c = c.astype(np.float64)
    order = np.argsort(-(c.sum(0) + c.sum(1))[:-1], kind="stable")
    of = np.empty(words, np.int64)
    of[order] = np.arange(words - 1) % max(classes - 1, 1)
    of[-1] = classes - 1
    one = np.eye(classes)[of]
    after, before = c @ one, c.T @ one
    g = one.T @ after
    for _ in range(passes):
        moved = 0
        for w in order:
            a, r, s, own = of[w], after[w].copy(), before[w].copy(), c[w, w]
            # r, s: w with each class, without itself.
            r[a] -= own
            s[a] -= own
            g[a] -= r
            g[:, a] -= s
            g[a, a] -= own
            # Wherever w goes, the classes around it get their bigrams with w back.
            left, right = g.sum(1) + s, g.sum(0) + r
            gain = (_h(g + r[None, :]) - _h(g)).sum(1) + (_h(g + s[:, None]) - _h(g)).sum(0)
            d = g.diagonal()
            gain += _h(d + r + s + own) - _h(d + r) - _h(d + s) + _h(d)
            gain -= _h(left + r.sum() + own) - _h(left) + _h(right + s.sum() + own) - _h(right)
            gain[classes - 1] = -np.inf
            k = int(gain.argmax())
            if gain[k] <= gain[a] + 1e-9:
                k = a
            g[k] += r
            g[:, k] += s
            g[k, k] += own
            if k != a:
                moved += 1
                of[w] = k
                after[:, a] -= c[:, w]
                after[:, k] += c[:, w]
                before[:, a] -= c[w]
                before[:, k] += c[w]
        if moved <= 0.005 * words:
            break
    return of


def best_classes(word: np.ndarray, slot: np.ndarray, times: np.ndarray, g: np.ndarray, rest: int) -> np.ndarray:
    """For each word 0, 1, ... of class ``rest``, the other class with the largest exchange gain.

    word (ascending), slot, times: its contexts (see ``SLOTS``); g: class bigram counts, with the words in ``rest``.
    """
    words = int(word[-1]) + 1 if len(word) else 0
    size = len(g)
    g = g.astype(np.float64)
    row, col, d = g.sum(1), g.sum(0), g.diagonal()
    out = np.empty(words, np.uint8)
    for start in range(0, words, WORDS_AT_ONCE):
        m = min(WORDS_AT_ONCE, words - start)
        i, j = np.searchsorted(word, (start, start + m))
        x = np.zeros((m, SLOTS))
        x[word[i:j] - start, slot[i:j]] = times[i:j]
        r, s, own = x[:, :size], x[:, CLASSES:CLASSES + size], x[:, -1:]
        gain = np.zeros((m, size))
        for part, cells in ((r, g.T), (s, g)):
            inner = part.copy()
            inner[:, rest] = 0
            at, k = np.nonzero(inner)
            if len(at):
                more = _h(cells[k] + inner[at, k][:, None]) - _h(cells)[k]
                first = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
                gain[at[first]] += np.add.reduceat(more, first)
        # The bigrams of each class with the word were counted as those with ``rest``.
        left, right = g[:, rest] - s, g[rest] - r
        gain += _h(left + r[:, [rest]]) - _h(left) + _h(right + s[:, [rest]]) - _h(right)
        gain += _h(d + r + s + own) - _h(d + r) - _h(d + s) + _h(d)
        gain -= _h(row + r.sum(1, keepdims=True) + own) - _h(row) + _h(col + s.sum(1, keepdims=True) + own) - _h(col)
        gain[:, rest] = -np.inf
        out[start:start + m] = gain.argmax(1)
    return out


class ClassModel:
    """Classes, transitions and totals, as small arrays."""

    def __init__(self, frequent: np.ndarray, of: np.ndarray, tokens: int, vocabulary: int):
        self.frequent, self.of = frequent, of  # sorted hashes and their classes
        self.end = CLASSES  # then words met once, then unseen words
        self.size = CLASSES + 3
        self.tokens, self.vocabulary = tokens, vocabulary
        self.log: np.ndarray | None = None

    def classes(self, words: np.ndarray, totals: np.ndarray, chosen: np.ndarray) -> np.ndarray:
        """chosen: classes of the words outside the frequent ones, or ``UNCLUSTERED``."""
        out = np.where(totals > 0, self.end + 1, self.size - 1)
        out[chosen != UNCLUSTERED] = chosen[chosen != UNCLUSTERED]
        number = _numbers(words, self.frequent)
        hit = number < len(self.frequent)
        out[hit] = self.of[number[hit]]
        out[words == END] = self.end
        return out

    def finish(self, g: np.ndarray, mass: np.ndarray) -> None:
        """g: class transitions; mass: tokens of each class."""
        g, mass = g.astype(np.float64), mass.astype(np.float64)
        once, unseen = self.end + 1, self.size - 1
        for x in (g.T, mass):
            x[unseen] = x[once] / 2
            x[once] -= x[unseen]
        g[unseen] = g[once]
        prior = (mass + 0.5) / (mass.sum() + 0.5 * self.size)
        self.transition = (g + TRANSITION_PRIOR * prior) / (g.sum(1, keepdims=True) + TRANSITION_PRIOR)
        self.mass = mass

    def scores(self, cls: np.ndarray, totals: np.ndarray, codes: np.ndarray, n: np.ndarray, end: int):
        """(known tokens, base score, class score) of the texts of a block; cls, totals: of its distinct words."""
        share = totals / np.maximum(self.mass[cls] + (self.mass[-1] if self.size else 0) * (cls == self.end + 1), 1)
        share = np.where(totals > 0, share, 1 / (self.vocabulary + 1))
        base = (totals + 1) / (self.tokens + self.vocabulary + 1)
        log_base, met = np.log10(base), totals > 0
        before = _pairs_before(n, codes, end)
        ends = np.cumsum(n)
        known, bases, scores = np.zeros(len(n), np.int64), np.zeros(len(n)), np.zeros(len(n))
        for s in range(0, len(codes), TOKENS_AT_ONCE):
            at = codes[s:s + TOKENS_AT_ONCE]
            p = WEIGHT * self.transition[cls[before[s:s + TOKENS_AT_ONCE]], cls[at]] * share[at] + (1 - WEIGHT) * base[at]
            # Texts of this range; one that goes on is added up over ranges.
            lo, hi = np.searchsorted(ends, (s, s + len(at) - 1), side="right")
            text = np.repeat(np.arange(hi - lo + 1), np.diff(np.clip(ends[lo:hi + 1], s, s + len(at)), prepend=s))
            known[lo:hi + 1] += np.bincount(text, met[at], hi - lo + 1).astype(np.int64)
            bases[lo:hi + 1] += np.bincount(text, log_base[at], hi - lo + 1)
            scores[lo:hi + 1] += np.bincount(text, np.log10(p), hi - lo + 1)
        return known, bases, scores


def brown_scores(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of (doc_id, held_out, text) rows.

    Learns from the rows that are not held out. Null texts count as empty: one token, the end. Repeated rows
    are scored, and learned from, each. Without training rows every base score is 0.
    """
    spark = ready(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "held_out", "text")
    blocks = staged(pack_blocks(rows), "blocks")
    number = blocks.count()
    buckets = max(LEAST_BUCKETS, -(-number // BUCKET_BLOCKS))
    tokens = blocks.agg(F.sum("train")).first()[0] or 0
    frequent = most_frequent(blocks, buckets)

    def frequent_pairs(row):
        held, n, codes = _block_arrays(row)
        words = np.frombuffer(row["words"], np.uint64)
        number = _numbers(words, frequent)
        before = _pairs_before(n, codes, int(np.flatnonzero(words == END)[0]))
        train = np.repeat(~held, n)
        return number[before[train]], number[codes[train]]

    c = _sum_matrix(blocks.select("held", "n", "words", "codes"), len(frequent) + 1, frequent_pairs)
    of = exchange_classes(c, CLASSES)
    one = np.eye(of.max() + 1, dtype=np.int64)[of]
    totals = add_totals(blocks, buckets, frequent, of, one.T @ c @ one)
    vocabulary = totals.agg(F.sum("vocabulary")).first()[0] or 0
    model = ClassModel(frequent, of[:-1], tokens, vocabulary)

    # Each block with the totals of its words, in bucket order: as many small values as the block has buckets.
    back = totals.groupBy("block").agg(F.array_sort(F.collect_list(F.struct("bucket", "totals", "classes"))).alias("totals"))

    def classified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # From here on classes stand for the words.
        for b in batches:
            for row in each_row(b):
                words = np.frombuffer(row["words"], np.uint64)
                counted, chosen, order = np.empty(len(words), np.int64), np.empty(len(words), np.uint8), np.argsort(words)
                counted[order] = np.concatenate([wide_from_planes(t["totals"]) for t in row["totals"]])
                chosen[order] = np.concatenate([np.frombuffer(t["classes"], np.uint8) for t in row["totals"]])
                new = [[row["ids"]], [row["held"]], [row["n"]], [row["codes"]], [wide_to_planes(counted)],
                       [model.classes(words, counted, chosen).astype(np.uint8).tobytes()], [int(np.flatnonzero(words == END)[0])]]
                types = [pa.list_(pa.int64()), *[pa.binary()] * 5, pa.int32()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(new, types)],
                                                 ["ids", "held", "n", "codes", "totals", "classes", "end_code"])

    # As many tasks as blocks: a task of many block rows would hold them all in one batch.
    full = staged(blocks.drop("counts", "train").repartition(max(number, 1), "block").join(back, "block").mapInArrow(
        classified, "ids array<bigint>, held binary, n binary, codes binary, totals binary, classes binary, end_code int"),
        "classified-blocks")

    def class_pairs(row):
        held, n, codes = _block_arrays(row)
        cls = np.frombuffer(row["classes"], np.uint8)
        before = _pairs_before(n, codes, row["end_code"])
        train = np.repeat(~held, n)
        return cls[before[train]], cls[codes[train]]

    g = _sum_matrix(full.select("held", "n", "codes", "classes", "end_code"), model.size, class_pairs)
    model.finish(g, g.sum(0))
    shared = spark.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in each_row(b):
                held, n, codes = _block_arrays(row)
                known, base, s = shared.value.scores(np.frombuffer(row["classes"], np.uint8),
                                                     wide_from_planes(row["totals"]), codes, n, row["end_code"])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["ids"], pa.int64()), pa.array(held), pa.array(n, pa.int64()), pa.array(known),
                     pa.array([tokens] * len(n), pa.int64()), pa.array(base), pa.array(s)],
                    ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return full.mapInArrow(score, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
                                  "base_score double, score double")


def op6_brown(spark, sf_dir: str) -> DataFrame:
    """Scores of every document, learned from those outside the held-out seventh."""
    from kiln.sources.tables import table

    ready(spark)
    docs = table(spark, sf_dir, "documents")
    return brown_scores(docs.select("doc_id", (id_bucket("doc_id", 7) == 2).alias("held_out"), "text"))
