"""Centroid clustering over a VA-file.

Vectors are cut into blocks of at most ``BLOCK_ROWS`` rows. Within a block every dimension is divided into
``CELLS`` cells of about equally many rows, and a vector becomes the numbers of its cells, four bits a dimension;
the least and largest value of every cell is kept. In each round a block makes lookup tables from a centroid and
the cells: the least and the largest squared difference that a value of the cell can have. Summed over the
dimensions they give an interval of the distance between a vector and each centroid. Centroids whose interval
begins beyond the smallest upper end are out; only where several intervals overlap are full vectors fetched from
the block and compared in whole numbers, ties to the smaller number. The means are exact, so each round adds up
the members' components, block by block, and only k x dimensions sums come to the driver.

Whole numbers up to ``LARGEST`` fit the interval arithmetic and 64-bit distances. Blocks or centroids with larger
ones are compared with unbounded integers throughout.

Defined results: vectors that are null, have another number of components, or hold a null or non-finite component
take no part, nor do those whose scaled components are no finite double. Rows that share an id are vectors of
their own; a null id orders last among the first centroids. Rows that tie in the seed hash are ordered by their
components. Fewer vectors than centroids: as many centroids as vectors. A distance beyond a 64-bit integer is
null, and so are the sums that hold it. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.llm.common import ready
from kiln.session import staged

BLOCK_ROWS = 2048
CELLS = 16
# Distances of 64 such components still fit 64 bits.
LARGEST = 1 << 27
# Table rows that are looked up and added at a time: keeps the sums in the processor's cache.
LOOKUP_ROWS = 512
FILE_SCHEMA = "ids array<long>, lows binary, highs binary, cells binary, kind string, vectors binary"


def scaled_vectors(df: DataFrame, id_col: str, vec_col: str, dims: int, scale: int) -> DataFrame:
    """(vec_id, v): scale * component, not yet floored, of every vector that takes part."""
    x = F.transform(F.col(vec_col), lambda c: c.cast("double") * float(scale))
    good = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return (df.select(F.col(id_col).cast("long").alias("vec_id"), x.alias("v"))
            .where(F.size("v") == dims).where(F.coalesce(good, F.lit(False))))


def approximate(m: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(lows, highs, cells): bounds per dimension and cell, and the cell of every component."""
    n, dims = m.shape
    order = np.sort(m, axis=0)
    marks = order[(np.arange(1, CELLS) * n) // CELLS]
    cells = np.empty((n, dims), np.uint8)
    lows, highs = np.empty((dims, CELLS)), np.empty((dims, CELLS))
    for d in range(dims):
        cells[:, d] = np.searchsorted(marks[:, d], m[:, d], side="right")
        ends = np.searchsorted(order[:, d], marks[:, d], side="left")
        starts, ends = np.append(0, ends), np.append(ends, n)
        lows[d], highs[d] = order[np.minimum(starts, n - 1), d], order[np.maximum(ends - 1, 0), d]
    return lows, highs, cells


def build_va_file(vectors: DataFrame) -> DataFrame:
    """Blocks of ``scaled_vectors`` output, floored: cells, their bounds, and the full vectors."""
    ready(vectors.sparkSession)

    def block(ids: list, m: np.ndarray) -> pa.RecordBatch:
        lows, highs, cells = approximate(m)
        size = np.abs(m).max(initial=0)
        kind = "<i2" if size < 1 << 15 else "<i4" if size < 1 << 31 else "<f8"
        packed = cells[:, 0::2] << 4
        packed[:, : cells[:, 1::2].shape[1]] |= cells[:, 1::2]
        values = [[ids], *([x.tobytes()] for x in (lows, highs, np.ascontiguousarray(packed.T))),
                  [kind], [m.astype(kind).tobytes()]]
        types = [pa.list_(pa.int64()), *[pa.binary()] * 3, pa.string(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, types)],
                                          ["ids", "lows", "highs", "cells", "kind", "vectors"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, parts = [], []
        for b in batches:
            if b.num_rows:
                ids += b.column("vec_id").to_pylist()
                parts.append(b.column("v").flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1))
            if len(ids) >= BLOCK_ROWS:
                m = np.floor(np.concatenate(parts))
                for s in range(0, len(ids) - BLOCK_ROWS + 1, BLOCK_ROWS):
                    yield block(ids[s:s + BLOCK_ROWS], m[s:s + BLOCK_ROWS])
                rest = len(ids) % BLOCK_ROWS
                ids, parts = ids[len(ids) - rest:], [m[len(m) - rest:]]
        if ids:
            yield block(ids, np.floor(np.concatenate(parts)))

    return vectors.mapInArrow(run, FILE_SCHEMA)


class Centroids:
    """Whole-number centroids as exact integers and, where they are small enough, as 64-bit ones."""

    def __init__(self, rows: list[list[int]]):
        self.rows = rows
        self.small = max((abs(x) for r in rows for x in r), default=0) <= LARGEST
        self.m = np.array(rows, np.int64) if self.small else np.array(rows, object)

    def digest(self, k: int) -> str:
        return hashlib.sha256(",".join(map(str, self.rows[k])).encode()).hexdigest()


def _bytes(b: pa.RecordBatch, column: str, i: int, dtype: str) -> np.ndarray:
    return np.frombuffer(b.column(column)[i].as_buffer(), dtype)


class Block:
    """One row of the file; full vectors are touched only through ``fetch``."""

    def __init__(self, b: pa.RecordBatch, i: int, dims: int):
        self.ids = b.column("ids")[i].values
        self.n, self.dims = len(self.ids), dims
        self.lows = _bytes(b, "lows", i, "<f8").reshape(dims, CELLS)
        self.highs = _bytes(b, "highs", i, "<f8").reshape(dims, CELLS)
        self.cells = _bytes(b, "cells", i, "u1").reshape(-1, self.n)
        self.full = _bytes(b, "vectors", i, b.column("kind")[i].as_py()).reshape(self.n, dims)
        self.small = max(-self.lows.min(initial=0), self.highs.max(initial=0)) <= LARGEST
        self.fetched = 0

    def fetch(self, rows, exact: bool) -> np.ndarray:
        """Full vectors of some rows as 64-bit or (not ``exact`` small) unbounded integers."""
        part = self.full[rows]
        if exact:
            return part.astype(np.int64)
        return np.array([[int(x) for x in r] for r in part.tolist()], object).reshape(-1, self.dims)

    def intervals(self, cents: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(first row, lower ends, upper ends) of the distances of some rows to all centroids.

        Sums of 32-bit floats of one sign: off by far less than the 1e-4 by which the ends are moved out.
        """
        k = len(cents)
        q = cents.T[:, None, :].astype(np.float64)
        lo, hi = self.lows[:, :, None], self.highs[:, :, None]
        near = np.maximum(np.maximum(lo - q, q - hi), 0) ** 2
        far = np.maximum(np.abs(q - lo), np.abs(hi - q)) ** 2
        table = np.concatenate([near, far], axis=2).astype(np.float32)
        if self.dims % 2:
            table = np.concatenate([table, np.zeros((1, CELLS, 2 * k), np.float32)])
        # One table per pair of dimensions, addressed by their packed cells.
        pairs = (table[0::2, :, None, :] + table[1::2, None, :, :]).reshape(-1, CELLS * CELLS, 2 * k)
        for s in range(0, self.n, LOOKUP_ROWS):
            total = np.zeros((min(LOOKUP_ROWS, self.n - s), 2 * k), np.float32)
            for t, code in zip(pairs, self.cells[:, s:s + LOOKUP_ROWS]):
                total += t[code]
            yield s, total[:, :k] * np.float32(1 - 1e-4), total[:, k:] * np.float32(1 + 1e-4)

    def nearest(self, c: Centroids) -> np.ndarray:
        """Number of the nearest centroid of every row."""
        if not (self.small and c.small):
            rows = self.fetch(slice(None), False)
            self.fetched += self.n
            return np.array([min(range(len(c.rows)), key=lambda k: (sum((x - y) ** 2 for x, y in zip(r, c.rows[k])), k))
                             for r in rows.tolist()], np.int64)
        out = np.empty(self.n, np.int64)
        for s, low, high in self.intervals(c.m):
            near = low <= high.min(1, keepdims=True)
            out[s:s + len(near)] = near.argmax(1)
            open_rows = np.flatnonzero(near.sum(1) > 1)
            if not len(open_rows):
                continue
            self.fetched += len(open_rows)
            at, k = np.nonzero(near[open_rows])
            x = self.fetch(s + open_rows, True)
            d = np.concatenate([((x[at[p:p + 16384]] - c.m[k[p:p + 16384]]) ** 2).sum(1)
                                for p in range(0, len(at), 16384)])
            first = np.searchsorted(at, np.arange(len(open_rows)))
            best = np.minimum.reduceat(d, first)
            hit = np.flatnonzero(d == best[at])
            out[s + open_rows] = k[hit[np.searchsorted(at[hit], np.arange(len(open_rows)))]]
        return out

    def distances(self, c: Centroids, which: np.ndarray) -> list[int | None]:
        """Exact squared distance of every row to its centroid; beyond 64 bits: None."""
        exact = self.small and c.small
        d = ((self.fetch(slice(None), exact) - c.m[which]) ** 2).sum(1).tolist()
        return d if exact else [int(x) if x < 1 << 63 else None for x in d]

    def sums(self, which: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
        """(centroid, members, sum of their vectors)."""
        order = np.argsort(which, kind="stable")
        at = np.flatnonzero(np.diff(which[order], prepend=-1))
        if len(at):
            total = np.add.reduceat(self.fetch(order, self.small), at)
            yield from zip(which[order][at].tolist(), np.diff(np.append(at, self.n)).tolist(), total)


def _blocks(batches: Iterator[pa.RecordBatch], dims: int) -> Iterator[Block]:
    for b in batches:
        for i in range(b.num_rows):
            yield Block(b, i, dims)


def _round(file: DataFrame, centroids: Centroids, dims: int) -> Centroids:
    """Centroids after one round: floors of the members' means, empty clusters as they were."""
    held = file.sparkSession.sparkContext.broadcast(centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        members: dict[int, int] = {}
        total: dict[int, list[int]] = {}
        for block in _blocks(batches, dims):
            for k, n, s in block.sums(block.nearest(held.value)):
                members[k] = members.get(k, 0) + n
                total[k] = [a + b for a, b in zip(total.get(k, [0] * dims), s.tolist())]
        rows = [(k, d, members[k], x >> 64, x & ((1 << 64) - 1)) for k in total for d, x in enumerate(total[k])]
        if rows:
            big = pa.decimal128(38, 0)
            types = [pa.int32(), pa.int32(), pa.int64(), big, big]
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*rows), types)],
                                             ["k", "d", "n", "high", "low"])

    parts = file.mapInArrow(run, "k int, d int, n long, high decimal(38,0), low decimal(38,0)")
    sums = parts.groupBy("k", "d").agg(F.sum("n").alias("n"), F.sum("high").alias("high"), F.sum("low").alias("low"))
    rows = [list(r) for r in centroids.rows]
    for r in sums.collect():  # one row per centroid and dimension
        rows[r["k"]][r["d"]] = ((int(r["high"]) << 64) + int(r["low"])) // r["n"]
    held.unpersist()
    return Centroids(rows)


def first_centroids(vectors: DataFrame, k: int, seed: str) -> list[list[int]]:
    """The k vectors with the smallest SHA-256 of seed and id, floored."""
    rank = F.sha2(F.concat(F.lit(seed), F.col("vec_id").cast("string")).cast("binary"), 256)
    rows = vectors.orderBy(rank.asc_nulls_last(), "v").limit(k).collect()
    return [[int(np.floor(x)) for x in r["v"]] for r in rows]


def cluster(df: DataFrame, k: int, rounds: int, id_col: str = "vec_id", vec_col: str = "embedding",
            dims: int = 64, scale: int = 256, seed: str = "2:") -> tuple[DataFrame, list[list[int]]]:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) and the final centroids."""
    spark = ready(df.sparkSession)
    vectors = scaled_vectors(df, id_col, vec_col, dims, scale)
    c = Centroids(first_centroids(vectors, k, seed))
    file = staged(build_va_file(vectors), "va-file")
    for _ in range(rounds if c.rows else 0):
        c = _round(file, c, dims)
    held = spark.sparkContext.broadcast(c)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches, dims):
            which = block.nearest(held.value)
            yield pa.RecordBatch.from_arrays(
                [block.ids, pa.array(which, pa.int32()), pa.array(block.distances(held.value, which), pa.int64())],
                ["vec_id", "cluster", "distance"])

    found = staged(file.mapInArrow(run, "vec_id long, cluster int, distance long"), "clusters")
    sums = (found.groupBy("cluster")
            .agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s"), F.count_if(F.isnull("distance")).alias("gaps"))
            .collect())  # one row per centroid
    fits = lambda x, gaps: int(x) if not gaps and x is not None and x < 1 << 63 else None
    inertia = fits(sum(r["s"] or 0 for r in sums), sum(r["gaps"] for r in sums))
    per = [(r["cluster"], fits(r["s"], r["gaps"]), inertia, c.digest(r["cluster"])) for r in sums]
    facts = spark.createDataFrame(per, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    # One row per centroid.
    return (found.join(F.broadcast(facts), "cluster")
            .select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"), c.rows)


def op12_vafile(spark, sf_dir: str) -> DataFrame:
    """40 clusters of ``embeddings`` after five rounds."""
    from kiln.sources.tables import table

    return cluster(table(spark, sf_dir, "embeddings"), 40, 5)[0]


def _sql(rounds: int) -> str:
    assign = """
a{n} AS MATERIALIZED (
  SELECT row, arg_min(k, (s, k)) AS k, min(s) AS s FROM (
    SELECT v.row, c.k, CAST(list_sum(list_transform(list_zip(v.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT) AS s
    FROM v CROSS JOIN c{n} c) GROUP BY row)"""
    move = """
c{m} AS MATERIALIZED (
  SELECT c.k, coalesce(m.v, c.v) AS v FROM c{n} c LEFT JOIN (
    SELECT k, list((s - ((s % n) + n) % n) // n ORDER BY d) AS v FROM (
      SELECT a.k, x.d, CAST(sum(x.c) AS BIGINT) AS s, count(*) AS n
      FROM a{n} a JOIN (SELECT row, unnest(v) AS c, generate_subscripts(v, 1) AS d FROM v) x ON x.row = a.row
      GROUP BY ALL) GROUP BY k) m ON m.k = c.k)"""
    steps = [assign.format(n=n) + "," + move.format(n=n, m=n + 1) for n in range(rounds)]
    return f"""
WITH v AS MATERIALIZED (
  SELECT vec_id, row_number() OVER () AS row,
         list_transform(embedding, lambda c: CAST(floor(256 * CAST(c AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY h, v) - 1 AS k, v FROM (
    SELECT sha256('2:' || vec_id) AS h, v FROM v ORDER BY h, v LIMIT 40)),
{",".join(steps)},{assign.format(n=rounds)}
SELECT v.vec_id, CAST(a.k AS INTEGER) AS cluster, a.s AS distance,
       CAST(sum(a.s) OVER (PARTITION BY a.k) AS BIGINT) AS cluster_inertia, CAST(sum(a.s) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(c.v, ',')) AS centroid_sha256
FROM a{rounds} a JOIN v ON v.row = a.row JOIN c{rounds} c ON c.k = a.k
"""


OP12_SQL = _sql(5)
