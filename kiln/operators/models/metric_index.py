"""Exact nearest neighbours by a metric index of pivot cells, as Spark jobs.

Index. Pivots are training vectors chosen by a hash of the id, about the square root of the row count and
``PIVOT_NUMBERS`` numbers at most; they and one summary row per cell are all that reaches the driver. Every training row
belongs to the cell of its nearest pivot. Cells are Spark rows: pages of at most ``PAGE_ROWS`` vectors, cut in
the order of the distance to the pivot, each with the least and largest of these distances. Where many rows lie
close together many pivots do too, so such a region is spread over many cells; of rows with equal vectors only
those that can be among the k nearest of any query are indexed.

Search, in two rounds. First every query is compared with the cells nearest to it that hold k rows; its k-th
distance bounds the answer. Then it is sent to the pages that this bound and the triangle inequality cannot
rule out, by three tests: the cell's radius, the plane halfway between the two pivots, and the page's ring of
distances. No other page can hold a neighbour, so the second round proves the answer. Queries travel in blocks,
joined with pages by cell, and a pair of page and block is compared with numpy. Where the tests leave a query more than
``COPIES`` cells on average (many dimensions, no clusters), queries would travel too often. Then both sides are dealt to a
grid instead, ``SIDES`` parts or more a side, each of about ``PART_NUMBERS`` numbers: every part of queries meets every
part of pages once, and the same tests are made there, page by page. So a row travels a fixed number of times, and the
distances that remain are screened by a matrix product whose rounding is bounded, then computed as elsewhere.

Distances are squared Euclidean, summed dimension by dimension; ties go to the smaller training id. Training rows
without id or vector, or with a null, NaN or infinite component, take no part, and queries with such a vector have
no neighbours. All vectors have the same length.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kiln.session import spread, staged

# Numbers that all pivots together may have: they are broadcast.
PIVOT_NUMBERS = 500_000
PAGE_ROWS = 512
# Queries compared with a page at once.
BLOCK_QUERIES = 256
# Bounds are loosened by this share, far more than the rounding of the distances.
SLACK = 1e-9
# Cells that a query may be sent to on average; sides of the grid at least, numbers of one of its parts.
COPIES, SIDES, PART_NUMBERS = 16, 8, 4_000_000
# Queries of a part compared with a page at once; rounding of a distance by products, per dimension and squared length.
TILE, ROUNDING = 4096, 1e-15


def finite(vec: str) -> Column:
    """Whether a vector has numbers only; false for a null one."""
    return F.coalesce(F.forall(vec, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))), F.lit(False))


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of a to all rows of b, as left-to-right sums over the dimensions."""
    out = np.zeros((len(a), len(b)))
    for j in range(a.shape[1]):
        diff = a[:, j, None] - b[None, :, j]
        out += diff * diff
    return out


def pair_distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of a's rows to b's, one by one, summed as by :func:`distances`."""
    out = np.zeros(len(a))
    for j in range(a.shape[1]):
        diff = a[:, j] - b[:, j]
        out += diff * diff
    return out


def matrix(column: pa.Array, dims: int) -> np.ndarray:
    """Rows of an Arrow list column."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


class Cells:
    """Pivots, and per cell its rows and radius: what queries are routed by."""

    def __init__(self, pivots: np.ndarray):
        self.pivots = pivots
        self.rows = np.zeros(len(pivots), np.int64)
        self.radius = np.zeros(len(pivots))

    def nearest_with(self, d: np.ndarray, k: int) -> np.ndarray:
        """Flags (query, cell): the nearest cells that together hold k rows."""
        order = np.argsort(d, axis=1, kind="stable")
        held = np.cumsum(self.rows[order], axis=1) - self.rows[order]
        out = np.zeros(d.shape, bool)
        np.put_along_axis(out, order, held < k, axis=1)
        return out & (self.rows > 0)

    def open_cells(self, d: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """Flags (query, cell): cells that may hold a row at most ``bound`` away (d: to the pivots)."""
        own = d.argmin(1)
        reach = bound[:, None] * (1 + SLACK) + SLACK * d
        out = (self.rows > 0) & (d - self.radius <= reach)
        # A row of another cell lies beyond the plane halfway between its pivot and the query's.
        homes, at = np.unique(own, return_inverse=True)
        between = np.sqrt(distances(self.pivots[homes], self.pivots))[at]
        with np.errstate(divide="ignore", invalid="ignore"):
            plane = (d * d - (d * d)[np.arange(len(d)), own][:, None]) / (2 * between)
        return out & ~((between > 0) & (plane > reach))


def fit_pivots(rows: DataFrame, dims: int, n: int) -> np.ndarray:
    """Distinct pivots from rows (tid, v), by a hash of the id."""
    wanted = max(1, min(PIVOT_NUMBERS // max(dims, 1), int(np.ceil(np.sqrt(n)))))
    picked = rows.orderBy(F.xxhash64("tid", F.lit("pivot")), "tid").limit(wanted).select("v").collect()
    return np.unique(np.array([r["v"] for r in picked], np.float64).reshape(-1, dims), axis=0)


def indexed_rows(train: DataFrame, k: int, exclude_self: bool) -> DataFrame:
    """Of equal vectors, the rows with the smallest ids: as many as a query can need."""
    same = Window.partitionBy("v", "tid").orderBy("label")
    rows = train.withColumn("_n", F.row_number().over(same)).where(F.col("_n") <= k)
    # Limits on window ranks are applied within each task first, so copies do not travel.
    ids = Window.partitionBy("v").orderBy("tid")
    return rows.withColumn("_n", F.dense_rank().over(ids)).where(F.col("_n") <= k + int(exclude_self)).drop("_n")


def build_pages(rows: DataFrame, cells: Cells, dims: int) -> DataFrame:
    """(cell, near, far, n, tids, labels, vectors): pages of rows (tid, label, v), in each page by id."""
    tid, label = rows.schema["tid"].dataType.simpleString(), rows.schema["label"].dataType.simpleString()
    sent = rows.sparkSession.sparkContext.broadcast(cells.pivots)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            v = matrix(b.column("v"), dims)
            d = np.concatenate([distances(v[s:s + 1024], sent.value) for s in range(0, len(v), 1024)] or [np.zeros((0, 1))])
            cell = d.argmin(1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(cell, pa.int32()), pa.array(np.sqrt(d[np.arange(len(v)), cell])), b.column("tid"), b.column("label"),
                 b.column("v")], ["cell", "r", "tid", "label", "v"])

    def pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for b in batches:
            cell = b.column("cell").to_numpy(zero_copy_only=False)
            cuts = [0, *(np.flatnonzero(np.diff(cell)) + 1).tolist(), len(cell)]
            for s, e in zip(cuts, cuts[1:]):
                if held and held[0].column("cell")[0].as_py() != cell[s]:
                    yield page(held)
                    held = []
                while s < e:
                    take = min(e - s, PAGE_ROWS - sum(h.num_rows for h in held))
                    held.append(b.slice(s, take))
                    s += take
                    if sum(h.num_rows for h in held) == PAGE_ROWS:
                        yield page(held)
                        held = []
        if held:
            yield page(held)

    def page(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        t = pa.Table.from_batches(parts).sort_by([("tid", "ascending"), ("label", "ascending")]).combine_chunks()
        n, r = t.num_rows, t.column("r").to_numpy()
        one = lambda x: pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), x.chunk(0))
        v = matrix(t.column("v").chunk(0), dims)
        return pa.RecordBatch.from_arrays(
            [t.column("cell").chunk(0).slice(0, 1), pa.array([r.min()]), pa.array([r.max()]), pa.array([n], pa.int32()),
             one(t.column("tid")), one(t.column("label")), pa.array([v.tobytes()], pa.binary())],
            ["cell", "near", "far", "n", "tids", "labels", "vectors"])

    assigned = rows.mapInArrow(assign, f"cell int, r double, tid {tid}, label {label}, v array<double>")
    ordered = assigned.repartitionByRange("cell", "r", "tid").sortWithinPartitions("cell", "r", "tid")
    return staged(ordered.mapInArrow(pages, f"cell int, near double, far double, n int, tids array<{tid}>, "
                                            f"labels array<{label}>, vectors binary"), "pages")


def sorted_queries(query: DataFrame, cells: Cells, dims: int) -> DataFrame:
    """(row, qid, v, home) in the order of the nearest pivot ``home``, so that a batch's queries ask for the same cells."""
    kind = query.schema["qid"].dataType.simpleString()
    sent = query.sparkSession.sparkContext.broadcast(cells.pivots)

    def home(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            v = matrix(b.column("v"), dims)
            near = [distances(v[s:s + 1024], sent.value).argmin(1) for s in range(0, len(v), 1024)]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(near or [np.zeros(0, int)]), pa.int32()), b.column("qid"),
                                              b.column("v")], ["home", "qid", "v"])

    homed = spread(query).mapInArrow(home, f"home int, qid {kind}, v array<double>")
    return staged(homed.repartitionByRange("home", F.xxhash64("qid")).sortWithinPartitions("home")
                  .select(F.monotonically_increasing_id().alias("row"), "qid", "v", "home"), "queries")


def _routed(queries: DataFrame, cells: Cells, dims: int, k: int, kind: str) -> DataFrame:
    """Blocks of queries by the cell they must be compared with: rows (row, qid, v) ask for the first round's
    cells, rows with a ``bound`` for all that are open after it."""
    sent = queries.sparkSession.sparkContext.broadcast(cells)
    second = "bound" in queries.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = sent.value
        for b in batches:
            for s in range(0, b.num_rows, 2048):
                part = b.slice(s, 2048)
                v = matrix(part.column("v"), dims)
                d = np.sqrt(distances(v, c.pivots))
                ask = c.nearest_with(d, k)
                bound = np.full(len(v), np.inf)
                if second:
                    bound = part.column("bound").to_numpy()
                    ask = c.open_cells(d, bound) & ~ask
                rows, qids = part.column("row").to_numpy(), part.column("qid")
                for cell in np.flatnonzero(ask.any(0)):
                    some = np.flatnonzero(ask[:, cell])
                    some = some[np.argsort(d[some, cell], kind="stable")]
                    for t in range(0, len(some), BLOCK_QUERIES):
                        q = some[t:t + BLOCK_QUERIES]
                        reach = bound[q] * (1 + SLACK) + SLACK * d[q, cell]
                        low, high = d[q, cell] - reach, d[q, cell] + reach
                        values = [[cell], [low.min()], [high.max()], [rows[q].tobytes()], [v[q].tobytes()],
                                  [low.tobytes()], [high.tobytes()], [(bound[q] ** 2 * (1 + SLACK)).tobytes()]]
                        types = [pa.int32(), pa.float64(), pa.float64(), *[pa.binary()] * 5]
                        ids = pa.ListArray.from_arrays(pa.array([0, len(q)], pa.int32()), qids.take(pa.array(q)))
                        yield pa.RecordBatch.from_arrays(
                            [*(pa.array(x, y) for x, y in zip(values, types)), ids],
                            ["cell", "low", "high", "rows", "v", "lows", "highs", "bounds", "qids"])

    return queries.mapInArrow(run, "cell int, low double, high double, rows binary, v binary, lows binary, highs binary, "
                                   f"bounds binary, qids array<{kind}>")


def nearest_in_page(page: np.ndarray, block: np.ndarray, keep: Callable[[np.ndarray], np.ndarray],
                    k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query place, page place, distance) of the k nearest kept pairs per query, ties to the smaller place.

    keep: function of the distance matrix giving the pairs that count.
    """
    d = distances(block, page)
    d[~keep(d)] = np.inf
    kth = np.partition(d, k - 1, axis=1)[:, k - 1] if k < len(page) else np.full(len(block), np.inf)
    qi, pi = np.nonzero((d <= kth[:, None]) & np.isfinite(d))
    order = np.lexsort((pi, d[qi, pi], qi))
    qi, pi = qi[order], pi[order]
    first = np.arange(len(qi)) - np.searchsorted(qi, qi) < k
    return qi[first], pi[first], d[qi[first], pi[first]]


def _hits(pages: DataFrame, blocks: DataFrame, dims: int, k: int, exclude_self: bool) -> DataFrame:
    """(row, dist, tid, label): each query's k nearest of every page it is compared with."""
    tid, label = (pages.schema[x].dataType.elementType.simpleString() for x in ("tids", "labels"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                get = lambda x, i=i: np.frombuffer(b.column(x)[i].as_buffer(), np.float64)
                page, block = get("vectors").reshape(-1, dims), get("v").reshape(-1, dims)
                ring = (get("lows") <= b.column("far")[i].as_py()) & (get("highs") >= b.column("near")[i].as_py())
                tids, labels = b.column("tids")[i].values, b.column("labels")[i].values
                own = np.zeros((len(block), len(page)), bool)
                if exclude_self:
                    places: dict = {}
                    for at, t in enumerate(tids.to_pylist()):
                        places.setdefault(t, []).append(at)
                    for at, q in enumerate(b.column("qids")[i].as_py()):
                        own[at, places.get(q, [])] = True
                bounds = get("bounds")
                qi, pi, d = nearest_in_page(page, block, lambda x: ring[:, None] & ~own & (x <= bounds[:, None]), k)
                rows = np.frombuffer(b.column("rows")[i].as_buffer(), np.int64)
                at = pa.array(pi)
                yield pa.RecordBatch.from_arrays([pa.array(rows[qi]), pa.array(d), tids.take(at), labels.take(at)],
                                                 ["row", "dist", "tid", "label"])

    met = pages.join(blocks, "cell").where("near <= high and far >= low")
    return met.drop("low", "high", "n", "cell").mapInArrow(run, f"row long, dist double, tid {tid}, label {label}")


def open_pairs(known: DataFrame, cells: Cells, dims: int) -> int:
    """Pairs of a query (v, bound) and a cell that its bound leaves open."""
    sent = known.sparkSession.sparkContext.broadcast(cells)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = 0
        for b in batches:
            v, bound = matrix(b.column("v"), dims), b.column("bound").to_numpy()
            for s in range(0, len(v), 2048):
                total += int(sent.value.open_cells(np.sqrt(distances(v[s:s + 2048], sent.value.pivots)), bound[s:s + 2048]).sum())
        yield pa.RecordBatch.from_arrays([pa.array([total], pa.int64())], ["pairs"])

    return known.select("v", "bound").mapInArrow(run, "pairs long").agg(F.sum("pairs")).first()[0] or 0


def near_pairs(q: np.ndarray, page: np.ndarray, bound: np.ndarray, own: Callable[[np.ndarray, np.ndarray], np.ndarray] | None,
               k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """:func:`nearest_in_page` for pairs within the squared ``bound``, screened by a matrix product; own: pairs that do not count."""
    qn, pn = (q * q).sum(1), (page * page).sum(1)
    a = qn[:, None] + pn[None, :] - 2 * (q @ page.T)
    if own is not None:
        a[own(np.arange(len(q))[:, None], np.arange(len(page))[None, :])] = np.inf
    error = ROUNDING * (q.shape[1] + 8) * (np.sqrt(qn) + np.sqrt(pn.max())) ** 2
    limit = bound + error
    keep = ~(a > limit[:, None])  # also what overflowed
    wide = np.flatnonzero(keep.sum(1) > 4 * k)
    if len(wide):
        limit[wide] = np.fmin(limit[wide], np.partition(a[wide], k - 1, axis=1)[:, k - 1] + 2 * error[wide])
        keep[wide] = ~(a[wide] > limit[wide, None])
    qi, pi = np.nonzero(keep)
    if own is not None:
        counts = ~own(qi, pi)
        qi, pi = qi[counts], pi[counts]
    d = pair_distances(q[qi], page[pi])
    good = (d <= bound[qi]) & np.isfinite(d)
    qi, pi, d = qi[good], pi[good], d[good]
    order = np.lexsort((pi, d, qi))
    qi, pi, d = qi[order], pi[order], d[order]
    first = np.arange(len(qi)) - np.searchsorted(qi, qi) < k
    return qi[first], pi[first], d[first]


def _grid_hits(pages: DataFrame, known: DataFrame, cells: Cells, dims: int, k: int, exclude_self: bool, queries: int) -> DataFrame:
    """(row, dist, tid, label): the k nearest at least of every query (row, qid, v, home, bound) in each part of the pages."""
    tid, label = (pages.schema[x].dataType.elementType.simpleString() for x in ("tids", "labels"))
    sent = known.sparkSession.sparkContext.broadcast(cells)
    down, across = (max(SIDES, -(-n * dims // PART_NUMBERS)) for n in (queries, int(cells.rows.sum())))

    def part(own_side: Column, other: int, step: int, other_step: int) -> Column:
        others = F.sequence(F.lit(0), F.lit(other - 1))
        return F.explode(F.transform(others, lambda o: (own_side * step + o * other_step).cast("int"))).alias("part")

    asked = known.select(part(F.pmod(F.xxhash64("row"), F.lit(down)), across, across, 1), "row", "qid", "home", "v", "bound")
    held = pages.select(part(F.pmod(F.xxhash64("cell", "near", "far"), F.lit(across)), down, 1, across), "cell", "near", "far", "n",
                        "tids", "labels", "vectors")

    def run(asked: pa.Table, held: pa.Table) -> pa.Table:
        found: list[tuple] = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
        rows = asked.column("row").to_numpy()
        tids, labels = (pa.concat_arrays([pa.array([], held.schema.field(x).type.value_type),
                                          *(c.flatten() for c in held.column(x).chunks if len(c))]) for x in ("tids", "labels"))
        if asked.num_rows and held.num_rows:
            q, home = matrix(pa.concat_arrays([c for c in asked.column("v").chunks if len(c)]), dims), asked.column("home").to_numpy()
            bound = asked.column("bound").to_numpy() ** 2 * (1 + SLACK)
            best, pivots = np.full((len(q), k), np.inf), sent.value.pivots
            home_d = pair_distances(q, pivots[home])
            if exclude_self:
                code: dict = {}
                tcode = np.array([code.setdefault(t, len(code)) for t in tids.to_pylist()])
                qcode = np.array([code.get(x, -1) for x in asked.column("qid").to_pylist()])
            cell, near, far, n = (held.column(x).to_numpy() for x in ("cell", "near", "far", "n"))
            start, last = np.cumsum(n) - n, -1
            for i in np.argsort(cell, kind="stable").tolist():
                if cell[i] != last:
                    last, pivot = cell[i], pivots[cell[i]][None, :]
                    d2, between = distances(q, pivot)[:, 0], np.sqrt(distances(pivots, pivot)[:, 0])[home]
                    d = np.sqrt(d2)
                    with np.errstate(divide="ignore", invalid="ignore"):
                        plane = np.where(between > 0, (d2 - home_d) / (2 * between), -np.inf)
                reach = np.sqrt(bound) * (1 + SLACK) + SLACK * d
                some = np.flatnonzero(~((d - reach > far[i]) | (d + reach < near[i]) | (plane > reach)))  # also what overflowed
                page = np.frombuffer(held.column("vectors")[i].as_buffer(), np.float64).reshape(-1, dims)
                for s in range(0, len(some), TILE):
                    at, own = some[s:s + TILE], None
                    if exclude_self:
                        mine = tcode[start[i]:start[i] + n[i]]
                        own = lambda x, y, at=at, mine=mine: qcode[at][x] == mine[y]
                    qi, pi, dist = near_pairs(q[at], page, bound[at], own, k)
                    found.append((at[qi], start[i] + pi, dist))
                    new = np.full((len(at), k), np.inf)
                    new[qi, np.arange(len(qi)) - np.searchsorted(qi, qi)] = dist
                    hit = np.unique(qi)
                    best[at[hit]] = np.sort(np.concatenate([best[at[hit]], new[hit]], axis=1), axis=1)[:, :k]
                    bound[at[hit]] = np.minimum(bound[at[hit]], best[at[hit], k - 1])
        qi, at, dist = (np.concatenate(x) for x in zip(*found))
        if len(qi):
            inside = dist <= bound[qi]
            qi, at, dist = qi[inside], at[inside], dist[inside]
        return pa.table([pa.array(rows[qi], pa.int64()), pa.array(dist), tids.take(pa.array(at)), labels.take(pa.array(at))],
                        ["row", "dist", "tid", "label"])

    return asked.groupBy("part").cogroup(held.groupBy("part")).applyInArrow(run, f"row long, dist double, tid {tid}, label {label}")


def _best(hits: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("row").orderBy("dist", "tid", "label")
    return hits.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= k).drop("_n")


class MetricIndex:
    """Pages and cells of a training table (tid, label, v)."""

    def __init__(self, train: DataFrame, k: int, exclude_self: bool):
        self.k, self.exclude_self = k, exclude_self
        train = train.where("tid is not null").where(finite("v"))
        n, dims = train.agg(F.count(F.lit(1)), F.max(F.size("v"))).first()
        self.n, self.dims = n, dims or 0
        # A query may have to leave out its own row.
        self.need = k + int(exclude_self)
        if not n:
            return
        self.cells = Cells(fit_pivots(train, self.dims, n))
        self.pages = build_pages(spread(indexed_rows(train, k, exclude_self)), self.cells, self.dims)
        # One row per cell.
        for r in self.pages.groupBy("cell").agg(F.sum("n").alias("n"), F.max("far").alias("far")).collect():
            self.cells.rows[r["cell"]], self.cells.radius[r["cell"]] = r["n"], r["far"]

    def bounded(self, queries: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Best hits of the first round, and the queries with the ``bound`` that these give, for :func:`sorted_queries` rows."""
        first = _routed(queries, self.cells, self.dims, self.need, queries.schema["qid"].dataType.simpleString())
        near = staged(_best(_hits(self.pages, first, self.dims, self.k, self.exclude_self), self.k), "near")
        bound = near.groupBy("row").agg(F.when(F.count(F.lit(1)) == self.k, F.sqrt(F.max("dist"))).alias("bound"))
        return near, queries.join(bound, "row", "left").withColumn("bound", F.coalesce("bound", F.lit(float("inf"))))

    def rounds(self, queries: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Best hits of the first round, and blocks of the second, for :func:`sorted_queries` rows."""
        near, known = self.bounded(queries)
        return near, _routed(known, self.cells, self.dims, self.need, queries.schema["qid"].dataType.simpleString())

    def search(self, query: DataFrame) -> DataFrame:
        """(qid, nn) for every row (qid, v) of ``query``: its k nearest as array<struct<dist, tid, label>>."""
        tid, label = (self.pages.schema[x].dataType.elementType.simpleString() for x in ("tids", "labels"))
        queries = sorted_queries(query.where(finite("v")), self.cells, self.dims)
        near, known = self.bounded(queries)
        known, asked = staged(known, "known"), queries.count()
        if open_pairs(known, self.cells, self.dims) <= COPIES * asked:
            second = _routed(known, self.cells, self.dims, self.need, queries.schema["qid"].dataType.simpleString())
            found = near.unionByName(_hits(self.pages, second, self.dims, self.k, self.exclude_self))
        else:  # meets the first round's cells again
            found = _grid_hits(self.pages, known, self.cells, self.dims, self.k, self.exclude_self, asked)
        nn = _best(found, self.k).groupBy("row").agg(F.array_sort(F.collect_list(F.struct("dist", "tid", "label"))).alias("nn"))
        empty = F.array().cast(f"array<struct<dist: double, tid: {tid}, label: {label}>>")
        out = queries.join(nn, "row", "left").select("qid", F.coalesce("nn", empty).alias("nn"))
        return out.unionByName(query.where(~finite("v")).select("qid", empty.alias("nn")))
