"""Exact top-k search by integer inner product over an impact-ordered index.

Index: vectors are cut into blocks of at most ``BLOCK_ROWS`` rows, one index row per block.
Within a block every component becomes a posting (dimension, row, sign) with a quantised
impact, its magnitude in steps of 1/``LEVELS`` of the block's largest. Postings are stored by
descending impact; all postings of one impact level form a segment.

Search, score at a time: segments are read by descending impact and added to the partial
scores of all queries of a query block at once. After each group of segments an upper and a
lower bound of every score is known: a posting that was read is off by half a step at most,
one that was not is smaller than the level reached. Reading stops only on proof: when the rows
whose upper bound reaches the k-th best lower bound are few, no other row can be a member, ties
included. The possible members are then scored exactly with whole-number arithmetic; if the
bounds never get that sharp, all segments are read and every possible member is scored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kiln.llm.common import ready
from kiln.session import staged

BLOCK_ROWS = 1024
LEVELS = 64
# Queries that are broadcast together; more queries make more passes over the index.
QUERY_BLOCK = 8192
# Scaled components beyond this would overflow the long score of 64 dimensions and more.
LARGEST = 1 << 27
INDEX_SCHEMA = "block long, n int, dims int, step long, ids binary, components binary, ends binary, postings binary"


def integer_vectors(df: DataFrame, id_col: str, vec_col: str, scale: int) -> DataFrame:
    """(vec_id, v): floor(scale * component) of every vector that takes part.

    Left out: null ids, null vectors, vectors with a null or non-finite component, and vectors with a
    scaled component beyond ``LARGEST`` (their scores do not fit a long).
    """
    x = F.transform(F.col(vec_col), lambda c: c.cast("double") * float(scale))
    good = F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) <= float(LARGEST)))
    return (df.select(F.col(id_col).alias("vec_id"), x.alias("x"))
            .where("vec_id is not null and x is not null").where(F.coalesce(good, F.lit(False)))
            .select("vec_id", F.transform("x", lambda c: F.floor(c)).alias("v")))


def _matrix(vectors: list[list[int]], dims: int) -> np.ndarray:
    """Rows padded with zeros to ``dims`` components."""
    out = np.zeros((len(vectors), dims), np.int64)
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


def build_impact_index(vectors: DataFrame) -> DataFrame:
    """Index rows of ``integer_vectors`` output; vectors shorter than others count as padded with zeros."""
    ready(vectors.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        block = TaskContext.get().partitionId() << 32
        for b in batches:
            for k in range(0, b.num_rows, BLOCK_ROWS):
                part = b.slice(k, BLOCK_ROWS)
                vecs = part.column("v").to_pylist()
                dims = max(map(len, vecs))
                m = _matrix(vecs, dims)
                size = np.abs(m)
                step = int(size.max(initial=0)) // LEVELS + 1
                level = (size // step).T.ravel()
                # A posting is dimension * rows + row, twice, plus 1 if negative.
                code = (np.arange(level.size, dtype=np.int64) * 2 + (m < 0).T.ravel()).astype(np.int32)
                order = np.argsort(LEVELS - 1 - level, kind="stable")
                ends = np.cumsum(np.bincount(LEVELS - 1 - level, minlength=LEVELS)).astype(np.int32)
                rows = [[block], [len(vecs)], [dims], [step],
                        [np.array(part.column("vec_id").to_pylist(), np.int64).tobytes()],
                        [m.astype(np.int32).tobytes()], [ends.tobytes()], [code[order].tobytes()]]
                types = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), *[pa.binary()] * 4]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(r, t) for r, t in zip(rows, types)],
                    ["block", "n", "dims", "step", "ids", "components", "ends", "postings"])
                block += 1

    return vectors.mapInArrow(run, INDEX_SCHEMA)


def search_block(row: dict, q_ids: np.ndarray, q: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k best rows of one index block for each query: (query position, row id, score)."""
    n, step = row["n"], row["step"]
    ids = np.frombuffer(row["ids"], np.int64)
    x = np.frombuffer(row["components"], np.int32).reshape(n, row["dims"])
    ends, postings = np.frombuffer(row["ends"], np.int32), np.frombuffer(row["postings"], np.int32)
    dims = max(q.shape[1], row["dims"])
    q = np.pad(q, ((0, 0), (0, dims - q.shape[1])))
    x = np.pad(x, ((0, 0), (0, dims - row["dims"])))
    qf = q.astype(np.float64)
    qa = np.abs(qf)
    own = q_ids[:, None] == ids[None, :]
    partial = np.zeros((len(q), n))
    spread = np.zeros((dims, n))
    member = ~own
    done, level = 0, LEVELS
    while level > 0:
        # Segment groups halve the impact reached; the last groups are single levels.
        level = level // 2 if level > 4 else level - 1
        upto = int(ends[LEVELS - 1 - level])
        seg = postings[done:upto]
        impact = np.repeat(np.arange(LEVELS), np.diff(ends, prepend=0))[done:upto]
        low = (LEVELS - 1 - impact) * step
        cell = seg >> 1
        add = np.zeros(dims * n)
        add[cell] = np.where(seg & 1, -1, 1) * (low + (step - 1) / 2)
        partial += qf @ add.reshape(dims, n)
        read = spread.reshape(-1)
        read[cell] = -1.0
        done = upto
        # Off by half a step if read; below the level reached if not.
        bound = np.where(spread < 0, (step - 1) / 2, max(level * step - 1, 0))
        bound[row["dims"]:] = 0
        err = qa @ bound
        err += 1 + 1e-9 * np.abs(partial)
        low_k = np.where(own, -np.inf, partial - err)
        kth = np.partition(low_k, n - k, axis=1)[:, n - k] if n > k else np.full(len(q), -np.inf)
        member = (partial + err >= kth[:, None]) & ~own
        if member.sum() <= 4 * k * len(q):
            break
    qi, ri = np.nonzero(member)
    score = np.empty(len(qi), np.int64)
    for s in range(0, len(qi), 1 << 16):
        score[s:s + (1 << 16)] = (q[qi[s:s + (1 << 16)]] * x[ri[s:s + (1 << 16)]].astype(np.int64)).sum(1)
    order = np.lexsort((ids[ri], -score, qi))
    qi, ri, score = qi[order], ri[order], score[order]
    first = np.searchsorted(qi, qi)
    keep = np.arange(len(qi)) - first < k
    return qi[keep], ids[ri[keep]], score[keep]


def exact_top_k(index: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k best index rows, ties to the smaller vec_id.

    queries: ``integer_vectors`` output; a repeated (vec_id, vector) asks once. Rows with the query's own id
    are no candidates, repeated candidates each count. Queries go in blocks of about ``QUERY_BLOCK`` against
    all index rows; each block is broadcast and its size does not depend on the data. No query or no
    candidate: no row.
    """
    spark = ready(index.sparkSession)
    queries = queries.distinct().withColumn("part", F.xxhash64("vec_id", "v"))
    total = queries.count()
    parts = max(1, -(-total // QUERY_BLOCK))
    found = None
    for p in range(parts):
        rows = queries.where(F.pmod("part", F.lit(parts)) == p).select("vec_id", "v").orderBy("vec_id", "v").collect()
        if not rows:
            continue
        dims = max(len(r[1]) for r in rows)
        held = spark.sparkContext.broadcast(
            (np.array([r[0] for r in rows], np.int64), _matrix([r[1] for r in rows], dims)))

        def run(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            q_ids, q = held.value
            for b in batches:
                for row in b.to_pylist():
                    for s in range(0, len(q_ids), 512):
                        qi, ids, score = search_block(row, q_ids[s:s + 512], q[s:s + 512], k)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(qi + s, pa.int32()), pa.array(q_ids[s:s + 512][qi]), pa.array(ids),
                             pa.array(score)], ["q", "query_id", "vec_id", "score"])

        hits = index.mapInArrow(run, "q int, query_id long, vec_id long, score long")
        # One query's block winners meet in one task: k rows per index block.
        best = Window.partitionBy("q").orderBy(F.desc("score"), "vec_id")
        top = (hits.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
               .select("query_id", "rank", "vec_id", "score"))
        found = top if found is None else found.unionByName(top)
    if found is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    return found


def op8_topk(spark, sf_dir: str) -> DataFrame:
    """Queries: ids divisible by 100 of ``embeddings``; candidates: every other row."""
    from kiln.sources.tables import table

    ready(spark)
    vectors = integer_vectors(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", 1024)
    index = staged(build_impact_index(vectors), "impact-index")
    return exact_top_k(index, vectors.where("vec_id % 100 = 0"), 10)


OP8_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda c: CAST(floor(1024 * CAST(c AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
x AS (SELECT vec_id, unnest(v) AS c, generate_subscripts(v, 1) AS d FROM v),
s AS (
  SELECT q.vec_id AS query_id, r.vec_id, CAST(sum(q.c * r.c) AS BIGINT) AS score
  FROM x q JOIN x r ON q.d = r.d AND q.vec_id <> r.vec_id
  WHERE q.vec_id % 100 = 0 GROUP BY ALL),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""
