import hashlib
import math
import random

import numpy as np
import pyarrow as pa
import pytest

from kiln.llm import vafile
from kiln.llm.vafile import Block, Centroids, approximate, build_va_file, cluster, scaled_vectors

SCHEMA = "vec_id long, embedding array<double>"


def brute(rows, k, rounds, dims, scale=256):
    """Plain Lloyd rounds with unbounded integers: [(id, cluster, distance)], centroids."""
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in rows
            if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    sha = lambda i: (i is None, hashlib.sha256(f"2:{i}".encode()).hexdigest())
    cents = [v for _, v in sorted(kept, key=lambda r: (*sha(r[0]), r[1]))[:k]]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(cents))
    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(near(v)[1], []).append(v)
        cents = [[sum(x) // len(groups[n]) for x in zip(*groups[n])] if n in groups else c for n, c in enumerate(cents)]
    return [(i, near(v)[1], near(v)[0]) for i, v in kept], cents


def check(spark, rows, k, rounds, dims, partitions=3):
    df = spark.createDataFrame(rows, SCHEMA).repartition(partitions)
    out, cents = cluster(df, k, rounds, dims=dims)
    got = out.collect()
    want, want_cents = brute(rows, k, rounds, dims)
    long = lambda x: x if x is not None and x < 1 << 63 else None
    key = lambda x: tuple((v is not None, v) for v in x)
    assert cents == want_cents
    assert sorted((tuple(r)[:3] for r in got), key=key) == sorted(((i, c, long(d)) for i, c, d in want), key=key)
    for r in got:
        own = [d for _, c, d in want if c == r["cluster"]]
        assert r["cluster_inertia"] == (long(sum(own)) if all(long(d) is not None for d in own) else None)
        assert r["inertia"] == (long(sum(d for *_, d in want)) if all(long(d) is not None for *_, d in want) else None)
        assert r["centroid_sha256"] == hashlib.sha256(",".join(map(str, want_cents[r["cluster"]])).encode()).hexdigest()


@pytest.mark.parametrize("dims", [4, 5])
def test_equals_plain_rounds_with_ties_repeats_and_odd_rows(spark, monkeypatch, dims):
    monkeypatch.setattr(vafile, "BLOCK_ROWS", 37)
    r = random.Random(dims)
    rows = [(i, [r.choice((-1.0, -0.5, 0.0, 0.5)) + r.choice((0, 0, r.gauss(0, 0.2))) for _ in range(dims)]) for i in range(400)]
    rows += [rows[5]] * 60 + [(5, [0.25] * dims), (None, [0.5] * dims)]
    rows += [(900, None), (901, [1.0] * (dims + 1)), (902, [None] * dims), (903, [math.nan] + [0.0] * (dims - 1)), (904, [math.inf] * dims)]
    check(spark, rows, 7, 4, dims)


def test_large_components_are_exact(spark):
    r = random.Random(1)
    for size in (200_000.0, 1e7, 1e30):
        rows = [(i, [r.choice((-size, 0.0, size)) * r.random() for _ in range(3)]) for i in range(60)]
        check(spark, rows, 5, 3, 3)


def test_fewer_vectors_than_centroids_and_empty_tables(spark):
    check(spark, [(1, [0.5, 1.0]), (2, [0.5, 1.0])], 5, 2, 2)
    empty = spark.createDataFrame([], SCHEMA)
    out, cents = cluster(empty, 5, 2, dims=2)
    assert out.count() == 0 and cents == []


def test_clashing_columns(spark):
    df = spark.createDataFrame([(1, [0.5, 1.0], 9, 8, "x")], "key long, vec array<float>, cluster int, row int, vec_id string")
    out = cluster(df, 1, 1, "key", "vec", dims=2)[0]
    assert [tuple(x)[:3] for x in out.collect()] == [(1, 0, 0)]


def test_cells_bound_their_rows():
    r = np.random.default_rng(2)
    m = np.floor(np.concatenate([r.normal(0, 50, (500, 6)), np.zeros((300, 6))]))
    lows, highs, cells = approximate(m)
    for d in range(6):
        assert (m[:, d] >= lows[d][cells[:, d]]).all() and (m[:, d] <= highs[d][cells[:, d]]).all()


def test_full_vectors_are_fetched_only_where_intervals_overlap(spark):
    r = np.random.default_rng(3)
    centres = r.normal(0, 1, (10, 64))
    rows = [(i, (centres[i % 10] + r.normal(0, 0.1, 64)).tolist()) for i in range(1000)]
    df = spark.createDataFrame(rows, SCHEMA).coalesce(1)
    file = build_va_file(scaled_vectors(df, "vec_id", "embedding", 64, 256)).toArrow().combine_chunks()
    batch = pa.RecordBatch.from_arrays([c.chunk(0) for c in file.columns], file.schema.names)
    block = Block(batch, 0, 64)
    which = block.nearest(Centroids(np.floor(256 * centres).astype(int).tolist()))
    assert which.tolist() == [i % 10 for i in range(1000)]
    assert block.fetched < 100
