import math
import random

import numpy as np

from kiln.llm import topk
from kiln.llm.topk import build_impact_index, exact_top_k, integer_vectors


def brute(rows, k):
    out = {}
    for q, v in {(i, tuple(v)) for i, v in rows}:
        score = sorted(((-sum(a * b for a, b in zip(v, w)), j) for j, w in rows if j != q))[:k]
        out[q, v] = [(j, -s) for s, j in score]
    return out


def vectors(spark, rows):
    return integer_vectors(spark.createDataFrame(rows, "id long, v array<float>"), "id", "v", 1024)


def test_equals_brute_force_with_ties_repeats_and_short_vectors(spark, monkeypatch):
    monkeypatch.setattr(topk, "QUERY_BLOCK", 7)
    r = random.Random(5)
    rows = [(i, [r.choice((-1.0, -0.25, 0.0, 0.5, 2.0)) * r.random() for _ in range(r.choice((3, 6, 6, 6)))]) for i in range(300)]
    rows += [(400, [0.5] * 6), (401, [0.5] * 6), (401, [0.5] * 6), (402, [])]
    v = vectors(spark, rows)
    whole = [(x["vec_id"], x["v"]) for x in v.collect()]
    assert len(whole) == len(rows)
    got = exact_top_k(build_impact_index(v), v.where("vec_id % 10 = 0"), 10).collect()
    want = brute(whole, 10)
    for (q, _), best in want.items():
        if q % 10 == 0:
            mine = sorted((x["rank"], x["vec_id"], x["score"]) for x in got if x["query_id"] == q)
            assert mine == [(n + 1, j, s) for n, (j, s) in enumerate(best)]


def test_vectors_that_take_no_part(spark):
    rows = [(1, [1.0, 2.0]), (2, None), (3, [None, 1.0]), (4, [float("nan"), 1.0]), (5, [math.inf, 1.0]), (None, [1.0, 1.0]),
            (6, [1e30, 1.0]), (7, [-0.0004, 1.0])]
    got = vectors(spark, rows).orderBy("vec_id").collect()
    assert [(x["vec_id"], x["v"]) for x in got] == [(1, [1024, 2048]), (7, [-1, 1024])]


def test_few_rows_and_empty_tables(spark):
    v = vectors(spark, [(100, [1.0]), (1, [3.0])])
    assert [tuple(x) for x in exact_top_k(build_impact_index(v), v.where("vec_id = 100")).collect()] == [(100, 1, 1, 3 * 1024 * 1024)]
    assert exact_top_k(build_impact_index(v), v.where("false")).count() == 0
    assert exact_top_k(build_impact_index(v.where("false")), v).count() == 0


def test_reading_stops_on_proof():
    r = np.random.default_rng(1)
    m = r.integers(-2000, 2000, (500, 16))
    size, step = np.abs(m), int(np.abs(m).max()) // topk.LEVELS + 1
    level = (size // step).T.ravel()
    code = (np.arange(level.size) * 2 + (m < 0).T.ravel()).astype(np.int32)
    order = np.argsort(topk.LEVELS - 1 - level, kind="stable")
    row = {"n": 500, "dims": 16, "step": step, "ids": np.arange(500).tobytes(), "components": m.astype(np.int32).tobytes(),
           "ends": np.cumsum(np.bincount(topk.LEVELS - 1 - level, minlength=topk.LEVELS)).astype(np.int32).tobytes(),
           "postings": code[order].tobytes()}
    q = r.integers(-2000, 2000, (4, 16))
    at, ids, score = topk.search_block(row, np.array([-1, -2, -3, -4]), q, 5)
    for i in range(4):
        want = sorted(((-int(s), j) for j, s in enumerate(q[i] @ m.T)))[:5]
        assert [(-s, j) for j, s in zip(ids[at == i].tolist(), score[at == i].tolist())] == want
