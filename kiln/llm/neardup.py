"""Near-duplicate groups: banded MinHash candidates, odd-sketch verification, exact check.

1. One pass over the texts: distinct shingles, a digest of the whole set, MinHash samples folded
   into band keys, and odd sketches: every sample flips one bit of a parity bitmap, so the bits in
   which two sketches differ count the samples that differ, which gives the similarity closely when
   it is high. A wider bitmap is folded from the whole set: in it two sets differ in no more bits than
   in shingles, so it rules pairs out without any error.
2. Texts with the same set are one node (its smallest id); only nodes go on.
3. Nodes that share a band key are candidates. The smallest node of a band leads: every other one is
   a candidate pair with it. Pairs whose sizes or sketches rule out the threshold (by more than six
   standard errors) go, the rest are compared on their full sets, and the links are joined into
   components.
4. What remains are candidates that share a band, lie in different components and do not lead. They
   are compared by both sketches in blocks of bounded size, members of the band's largest component
   only with the others, and again only pairs that the sketches admit are written and compared in full.

So no band is ever expanded into all its pairs, no candidate is dropped, and every link between
candidates is found or lies within a component already. With 24 bands of 5 samples a pair at
similarity 0.85 shares no band with probability 8e-7 (0.8: 7e-5, hence 32 bands there).
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.llm.common import mix64, ready, texts_of
from kiln.llm.graph import components
from kiln.llm.shingles import shingle_set
from kiln.session import staged

BAND_ROWS = 5
SKETCH_BITS = 512
SET_BITS = 2048
BLOCK = 512
BITMAP_BITS = 1 << 26
SHINGLE_CHUNK = 1 << 14


def bands_for(percent: int) -> int:
    """Bands for which a pair at the threshold is missed with a probability of 1e-6 at most."""
    return math.ceil(math.log(1e-6) / math.log(1 - (percent / 100) ** BAND_ROWS))


def sketch_limit(percent: int, samples: int) -> int:
    """Most differing sketch bits of a pair at the threshold, with more than six standard errors to spare."""
    t = percent / 100
    low = max(0.0, t - 6.5 * math.sqrt(t * (1 - t) / samples))
    flips = 2 * samples * (1 - low)
    return math.ceil(SKETCH_BITS / 2 * (1 - math.exp(-2 * flips / SKETCH_BITS)) + 10)


def odd_sketch(keys: np.ndarray, bits: int) -> np.ndarray:
    """Parity bitmap of hashed keys, as 64-bit words."""
    at = (keys % np.uint64(bits)).astype(np.int64)
    return np.packbits((np.bincount(at, minlength=bits) & 1).astype(np.uint8)).view(np.int64)


def signature(s: np.ndarray, bands: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(band keys, odd sketch of the samples, odd sketch of the set) of a non-empty shingle set."""
    k = bands * BAND_ROWS
    a = mix64(np.arange(1, k + 1, dtype=np.uint64)) | np.uint64(1)
    b = mix64(np.arange(k + 1, 2 * k + 1, dtype=np.uint64))
    least = np.full(k, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(s), SHINGLE_CHUNK):
        least = np.minimum(least, (s[i:i + SHINGLE_CHUNK, None] * a + b).min(0))
    rows = least.reshape(bands, BAND_ROWS)
    keys = np.arange(bands, dtype=np.uint64)
    for j in range(BAND_ROWS):
        keys = mix64(keys + rows[:, j])
    return keys.view(np.int64), odd_sketch(mix64(least + a), SKETCH_BITS), odd_sketch(mix64(s), SET_BITS)


def signatures(docs: DataFrame, words: int, bands: int, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, digest, bands, sketch, parity); the last four are null for a text without words."""
    ready(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, digest, keys, sketch, parity = [], [], [], [], []
            for t in texts_of(b, "text"):
                s = shingle_set(t, words)
                n.append(len(s))
                k, o, w = signature(s, bands) if len(s) else (None, None, None)
                digest.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
                keys.append(k)
                sketch.append(o)
                parity.append(w)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(n, pa.int64()), pa.array(digest, pa.binary()),
                 pa.array(keys, pa.list_(pa.int64())), pa.array(sketch, pa.list_(pa.int64())),
                 pa.array(parity, pa.list_(pa.int64()))],
                ["doc_id", "n_shingles", "digest", "bands", "sketch", "parity"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(
        run, "doc_id long, n_shingles long, digest binary, bands array<bigint>, sketch array<bigint>, "
             "parity array<bigint>")


def _differing(x: str, y: str):
    """Differing bits of two sketch columns."""
    words = [f"bit_count({x}[{i}] ^ {y}[{i}])" for i in range(SKETCH_BITS // 64)]
    return F.expr(" + ".join(words))


def _with_hint(rows: DataFrame, ids: DataFrame, id_col: str) -> DataFrame:
    """``rows`` with ``_kiln_maybe``: false only where ``id_col`` is not among the column ``id`` of ``ids``.

    The hint comes from a bitmap of the hashed ids, ``BITMAP_BITS`` long whatever the data, which is broadcast.
    """
    def place(c):
        return F.pmod(F.xxhash64(F.col(c).cast("long")), F.lit(BITMAP_BITS))

    maps = (ids.select(place("id").alias("_kiln_p")).groupBy(F.bitmap_bucket_number("_kiln_p").alias("_kiln_bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("_kiln_p")).alias("_kiln_bits")))
    bit = ("shiftright(cast(conv(hex(substring(_kiln_bits, bitmap_bit_position(_kiln_place) div 8 + 1, 1)), 16, 10) AS int), "
           "cast(bitmap_bit_position(_kiln_place) % 8 AS int)) & 1 = 1")
    return (rows.withColumn("_kiln_place", place(id_col)).withColumn("_kiln_at", F.bitmap_bucket_number("_kiln_place"))
            .join(F.broadcast(staged(maps, "bitmap")), F.col("_kiln_at") == F.col("_kiln_bucket"), "left")
            .select(*[rows[c] for c in rows.columns], F.coalesce(F.expr(bit), F.lit(False)).alias("_kiln_maybe")))


def rows_named(rows: DataFrame, ids: DataFrame, id_col: str = "id") -> DataFrame:
    """The rows whose ``id_col`` is among ``ids``; few others are shuffled for the join that decides."""
    hinted = _with_hint(rows, ids, id_col).where("_kiln_maybe").drop("_kiln_maybe")
    return hinted.join(ids.select(F.col("id").alias("_kiln_id")), F.col(id_col) == F.col("_kiln_id"), "left_semi")


def rows_not_named(rows: DataFrame, ids: DataFrame, id_col: str = "id") -> DataFrame:
    """The rows whose ``id_col`` is null or not among ``ids``; most pass without a shuffle."""
    hinted = _with_hint(rows, ids, id_col)
    other = hinted.where("_kiln_maybe").join(ids.select(F.col("id").alias("_kiln_id")), F.col(id_col) == F.col("_kiln_id"), "left_anti")
    return hinted.where("not _kiln_maybe").unionByName(other).drop("_kiln_maybe")


def verify(pairs: DataFrame, docs: DataFrame, words: int, percent: int, id_col: str, text: str) -> DataFrame:
    """The (a, b) whose full shingle sets reach the threshold."""
    pairs = staged(pairs, "pairs")
    ids = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    texts = staged(rows_named(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text).alias("t")),
                              staged(ids, "pair-ids")), "pair-texts")
    rows = (pairs.join(texts.select(F.col("id").alias("b"), F.col("t").alias("tb")), "b")
            .join(texts.select(F.col("id").alias("a"), F.col("t").alias("ta")), "a").select("a", "b", "ta", "tb"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, x = None, None  # rows of one leader come together
        for batch in batches:
            a, b = [], []
            for i, j, ta, tb in zip(*(c.to_pylist() for c in batch.columns)):
                if last != ta:
                    last, x = ta, shingle_set(ta, words)
                y = shingle_set(tb, words)
                both = len(x) + len(y)
                common = len(np.intersect1d(x, y, assume_unique=True))
                if 100 * common >= percent * (both - common):
                    a.append(i)
                    b.append(j)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return staged(rows.mapInArrow(run, "a long, b long").distinct(), "links")


def _remaining_pairs(members: DataFrame, nodes: DataFrame, labels: DataFrame, percent: int, limit: int) -> DataFrame:
    """Pairs of non-leading members of a band in different components that size and sketches admit."""
    owner = staged(nodes.select("rep").join(labels, F.col("rep") == F.col("node"), "left")
                   .select("rep", F.coalesce("component", "rep").alias("comp")), "owners")
    # Leading nodes are resolved; a band needs two more members in different components.
    mine = staged(members.where("rep <> leader").join(owner.select("rep", "comp"), "rep"), "followers")
    sizes = mine.groupBy("band", "comp").agg(F.count("*").alias("c"))
    bands = (sizes.groupBy("band").agg(F.sum("c").alias("total"), F.count("*").alias("comps"),
                                       F.max(F.struct("c", "comp")).alias("top")).where("comps > 1")
             .select("band", F.col("top.comp").alias("main"),
                     F.ceil(F.col("top.c") / BLOCK).alias("p"),
                     F.ceil((F.col("total") - F.col("top.c")) / BLOCK).alias("q")))
    rows = (mine.join(staged(bands, "open-bands"), "band")
            .withColumn("inner", (F.col("comp") == F.col("main")).cast("int"))
            .withColumn("i", F.pmod(F.xxhash64("rep"), F.when(F.col("inner") == 1, F.col("p")).otherwise(F.col("q")))))
    # A block of the main component meets every other block; other blocks meet each other once.
    meet = F.expr("""CASE WHEN inner = 1 THEN transform(sequence(0L, q - 1), j -> struct(i AS x, j AS y, 1 AS kind))
        ELSE concat(transform(sequence(0L, p - 1), j -> struct(j AS x, i AS y, 1 AS kind)),
                    transform(sequence(0L, q - 1), j -> struct(least(i, j) AS x, greatest(i, j) AS y, 0 AS kind))) END""")
    rows = (rows.select("band", "rep", "comp", "inner", "i", F.explode(meet).alias("m"))
            .select("band", "m.*", "rep", "comp", "inner", "i").join(nodes.select("rep", "n", "sketch", "parity"), "rep"))
    keys = ["band", "x", "y", "kind"]
    rows = rows.repartition(*keys).sortWithinPartitions(*keys).select(
        *keys, "rep", "comp", "n", "inner", "i", "sketch", "parity")

    def pairs_of(g: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        if g["kind"][0] == 1:
            left, right = np.flatnonzero(g["inner"] == 1), np.flatnonzero(g["inner"] == 0)
        else:
            left, right = np.flatnonzero(g["i"] == g["x"]), np.flatnonzero(g["i"] == g["y"])
        found_a, found_b = [], []
        for s in range(0, len(left), 64):
            part = left[s:s + 64]
            n1, n2 = g["n"][part][:, None], g["n"][right][None, :]
            ok = (g["comp"][part][:, None] != g["comp"][right][None, :]) & (
                100 * np.minimum(n1, n2) >= percent * np.maximum(n1, n2))
            u, v = np.nonzero(ok)
            x, y = part[u], right[v]
            near = np.bitwise_count(g["sketch"][x] ^ g["sketch"][y]).sum(1) <= limit
            x, y = x[near], y[near]
            # Two sets at the threshold differ in this many shingles at most, and their bitmaps in no more bits.
            most = (100 - percent) * (g["n"][x] + g["n"][y]) / (100 + percent)
            near = np.bitwise_count(g["parity"][x] ^ g["parity"][y]).sum(1) <= most
            found_a.append(g["rep"][x[near]])
            found_b.append(g["rep"][y[near]])
        none = np.empty(0, np.int64)
        return np.concatenate(found_a or [none]), np.concatenate(found_b or [none])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []

        def closed(parts):
            g = {c: np.concatenate([p[c] for p in parts]) for c in parts[0]}
            a, b = pairs_of(g)
            return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            cols = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in batch.schema.names
                    if c not in ("sketch", "parity")}
            for c in ("sketch", "parity"):
                cols[c] = batch.column(c).flatten().to_numpy().reshape(batch.num_rows, -1).view(np.uint64)
            new = np.zeros(batch.num_rows, bool)
            for c in keys:
                v = cols[c]
                new[1:] |= v[1:] != v[:-1]
                new[0] |= bool(held) and held[-1][c][-1] != v[0]
            cut = np.flatnonzero(new)
            edges = np.unique(np.concatenate([[0], cut, [batch.num_rows]]))
            for s, e in zip(edges[:-1], edges[1:]):
                if new[s] and held:
                    yield closed(held)
                    held = []
                held.append({c: v[s:e] for c, v in cols.items()})
        if held:
            yield closed(held)

    return rows.mapInArrow(run, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id",
                    text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row: its group under links of similarity
    >= percent / 100 between the sets of distinct ``words``-word shingles.

    Null and wordless texts have no shingle and no link. A null id gets a null component and is kept.
    Repeated rows with one id get the same row each. An empty table gives no row.
    """
    bands = bands_for(percent)
    limit = sketch_limit(percent, bands * BAND_ROWS)
    sigs = staged(signatures(docs, words, bands, id_col, text), "signatures")
    sets = staged(sigs.where("digest is not null and doc_id is not null").groupBy("digest")
                  .agg(F.min("doc_id").alias("rep")), "sets")
    nodes = staged(sigs.join(sets, (sigs.doc_id == sets.rep) & (sigs.digest == sets.digest))
                   .select("rep", F.col("n_shingles").alias("n"), "bands", "sketch", "parity").dropDuplicates(["rep"]), "nodes")
    keyed = nodes.select("rep", F.explode("bands").alias("band"))
    lead = staged(keyed.groupBy("band").agg(F.min("rep").alias("leader"), F.count("*").alias("c"))
                  .where("c > 1").select("band", "leader"), "leaders")
    members = staged(keyed.join(lead, "band"), "members")
    small = nodes.select("rep", "n", "sketch")
    star = (members.where("rep <> leader").select("leader", "rep").distinct()
            .join(small.select("rep", F.col("n").alias("nb"), F.col("sketch").alias("sb")), "rep")
            .join(small.select(F.col("rep").alias("leader"), F.col("n").alias("na"), F.col("sketch").alias("sa")), "leader")
            .where(100 * F.least("na", "nb") >= percent * F.greatest("na", "nb"))
            .where(_differing("sa", "sb") <= limit).select(F.col("leader").alias("a"), F.col("rep").alias("b")))
    links = verify(star, docs, words, percent, id_col, text)
    labels = staged(components(links), "labels")
    more = verify(_remaining_pairs(members, nodes, labels, percent, limit), docs, words, percent, id_col, text)
    # Each component as a star and the new links: their components are final.
    final = components(labels.where("node <> component").select(F.col("node").alias("a"), F.col("component").alias("b"))
                       .unionByName(more))
    by_set = staged(sets.join(final, F.col("rep") == F.col("node"), "left")
                    .select("digest", F.coalesce("component", "rep").alias("component")), "components")
    return (sigs.select("doc_id", "n_shingles", "digest").join(by_set, "digest", "left")
            .select("doc_id", "n_shingles",
                    F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))))


def op4_neardup(spark, sf_dir: str) -> DataFrame:
    """Groups of ``documents`` under 3-word shingles and similarity 0.85."""
    from kiln.sources.tables import table

    ready(spark)
    return near_duplicates(table(spark, sf_dir, "documents"), words=3, percent=85)
