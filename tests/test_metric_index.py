import numpy as np
import pytest
from pyspark.sql import functions as F

from kiln.operators.models import metric_index
from kiln.operators.models.metric_index import MetricIndex, sorted_queries
from kiln.operators.models.neighbors import neighbours

SCHEMA = "id long, label int, v array<double>"


def brute(train, query, k, exclude_self):
    """Sorted (query id, neighbours) by comparing everything."""
    ok = [(t, y, np.array(v)) for t, y, v in train if t is not None and v is not None and None not in v and np.isfinite(v).all()]
    out = []
    for qid, _, q in query:
        if q is None or None in q or not np.isfinite(q).all():
            out.append((qid, []))
            continue
        near = []
        for t, y, v in ok:
            if not (exclude_self and t == qid):
                d = 0.0
                for a, b in zip(q, v):
                    d += (a - b) * (a - b)
                near.append((d, t, y))
        out.append((qid, sorted(near)[:k]))
    return sorted(out, key=str)


def search(spark, train, query, k, exclude_self, partitions=3):
    nn = neighbours(spark.createDataFrame(train, SCHEMA).repartition(partitions),
                    spark.createDataFrame(query, SCHEMA).repartition(partitions), "v", "label", k, "id", "id", exclude_self)
    return sorted(((r["id"], [tuple(x) for x in r["nn"]]) for r in nn.collect()), key=str)


@pytest.mark.parametrize("dims,exclude_self", [(1, True), (3, False), (8, True)])
def test_equals_brute_force(spark, monkeypatch, dims, exclude_self):
    r = np.random.default_rng(dims)
    train = [(i, int(r.integers(4)), np.round(r.normal(3 * (i % 5), 1, dims), 1 if dims < 8 else 9).tolist()) for i in range(500)]
    query = train[::3] + [(9000 + i, 0, r.normal(0, 9, dims).tolist()) for i in range(40)]
    assert search(spark, train, query, 4, exclude_self) == brute(train, query, 4, exclude_self)


def test_copies_repeated_ids_and_odd_rows(spark):
    """A third of all rows is one vector; rows repeat, ids repeat with other vectors."""
    r = np.random.default_rng(1)
    train = [(i, i % 3, [1.0, 2.0]) for i in range(300)] + [(i, 1, r.normal(0, 2, 2).round(1).tolist()) for i in range(250, 850)]
    train += [(7, 0, [1.0, 2.0])] * 9 + [(None, 1, [1.0, 2.0]), (900, 1, None), (901, 1, [None, 1.0]), (902, 1, [float("nan"), 1.0]),
                                         (903, 1, [float("inf"), 0.0]), (904, None, [1.1, 2.0])]
    query = train[:20] + train[300:400] + train[-6:-1] + [(7, 0, [1.0, 2.0])] * 2
    got, want = search(spark, train, query, 5, True), brute([t for t in train if t[1] is not None] + [(904, -1, [1.1, 2.0])], query, 5, True)
    fix = [(q, [(d, t, -1 if y is None else y) for d, t, y in nn]) for q, nn in got]
    assert sorted(fix, key=str) == want


def test_fewer_rows_than_neighbours_and_empty_tables(spark):
    train = [(1, 0, [0.0]), (2, 1, [5.0])]
    assert search(spark, train, train, 4, True) == [(1, [(25.0, 2, 1)]), (2, [(25.0, 1, 0)])]
    assert search(spark, [], train, 4, False) == [(1, []), (2, [])]
    assert search(spark, train, [], 4, False) == []


def test_pages_are_bounded_and_rings_hold(spark, monkeypatch):
    monkeypatch.setattr(metric_index, "PIVOT_NUMBERS", 6)
    r = np.random.default_rng(2)
    df = spark.createDataFrame([(i, 0, r.normal(0, 1, 2).tolist()) for i in range(3000)], SCHEMA).withColumnRenamed("id", "tid")
    index = MetricIndex(df, 3, False)
    pages = index.pages.collect()
    assert len(index.cells.pivots) == 3 and sum(p["n"] for p in pages) == 3000 and max(p["n"] for p in pages) <= metric_index.PAGE_ROWS
    for p in pages:
        v = np.frombuffer(p["vectors"]).reshape(-1, 2)
        d = np.sqrt(metric_index.distances(v, index.cells.pivots))
        assert (d.argmin(1) == p["cell"]).all() and np.isclose([d[:, p["cell"]].min(), d[:, p["cell"]].max()], [p["near"], p["far"]]).all()


def test_most_distances_are_ruled_out_on_clustered_data(spark):
    r = np.random.default_rng(3)
    centres = r.normal(0, 10, (40, 16))
    rows = [(i, i % 40, (centres[i % 40] + r.normal(0, 0.5, 16)).tolist()) for i in range(4000)]
    df = spark.createDataFrame(rows, SCHEMA)
    index = MetricIndex(df.withColumnRenamed("id", "tid"), 5, True)
    queries = sorted_queries(df.select(F.col("id").alias("qid"), "v"), index.cells, index.dims)
    compared = 0
    near, second = index.rounds(queries)
    from kiln.operators.models.metric_index import _routed
    for blocks in (_routed(queries, index.cells, index.dims, 6, "bigint"), second):
        met = index.pages.join(blocks, "cell").where("near <= high and far >= low")
        compared += met.agg(F.sum(F.col("n") * F.size("qids"))).first()[0] or 0
    assert near.count() == 5 * len(rows)
    assert compared < 0.3 * len(rows) ** 2


@pytest.mark.parametrize("exclude_self", [True, False])
def test_grid_equals_brute_force(spark, monkeypatch, exclude_self):
    """The second round on the grid, several parts a side; copies, repeated and odd ids, large and equal coordinates."""
    monkeypatch.setattr(metric_index, "COPIES", 0)
    monkeypatch.setattr(metric_index, "PART_NUMBERS", 300)
    monkeypatch.setattr(metric_index, "TILE", 7)
    r = np.random.default_rng(5)
    train = [(i, i % 3, np.round(r.normal(0, 1, 3), 1).tolist()) for i in range(500)] + [(i, 1, [0.5, 0.5, 0.5]) for i in range(480, 530)]
    train += [(None, 1, [0.0] * 3), (901, 1, [None, 1.0, 1.0]), (902, 2, [1e9, 1e9, 1e9]), (903, 2, [1e9, 1e9, 1e9 + 1]), (904, 2, [1e200] * 3)]
    query = train[:60] + train[470:530] + train[-5:] + [(9000 + i, 0, r.normal(0, 4, 3).tolist()) for i in range(30)]
    got = search(spark, train, query, 4, exclude_self)
    with np.errstate(over="ignore"):
        want = [(q, [x for x in nn if np.isfinite(x[0])]) for q, nn in brute(train, query, 4, exclude_self)]
    assert got == want


def test_rows_travel_a_fixed_number_of_times(spark):
    """Without clusters the bounds rule nothing out; a query then goes to the parts of the grid, not to all cells."""
    sent = []
    for n in (1000, 4000):
        v = np.random.default_rng(6).normal(0, 1, (n, 24))
        index = MetricIndex(spark.createDataFrame([(i, 0, x.tolist()) for i, x in enumerate(v)], "tid long, label int, v array<double>"), 4, True)
        queries = sorted_queries(spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "qid long, v array<double>"), index.cells, index.dims)
        _, known = index.bounded(queries)
        assert metric_index.open_pairs(known, index.cells, index.dims) > metric_index.COPIES * n
        hits = metric_index._grid_hits(index.pages, known, index.cells, index.dims, 4, True, n)
        sent.append(hits.count() / n)
    assert max(sent) <= 4 * metric_index.SIDES


def test_few_rows_leave_parts_of_the_grid_empty(spark, monkeypatch):
    monkeypatch.setattr(metric_index, "COPIES", 0)
    rows = [(1, 0, [0.0, 1.0]), (2, 1, [5.0, 1.0]), (3, None, [0.0, 1.5])]
    assert search(spark, rows, rows, 1, True) == [(1, [(0.25, 3, None)]), (2, [(25.0, 1, 0)]), (3, [(0.25, 1, 0)])]
