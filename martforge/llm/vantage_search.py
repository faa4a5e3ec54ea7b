"""Nearest neighbours by vantage-point trees, one per shard.

A node of a tree holds a vantage point and the ranges of distances of its inner and its outer half to it.
By the triangle inequality no vector of a half with range [lo, hi] is nearer to a query at distance d from
the vantage point than max(lo - d, d - hi); a half is left out if ``factor`` times that bound is above the
query's k-th best distance. Factor 1 restores exact search, larger ones leave out more.

Shards. A tree over a bounded, documented sample of vectors cuts space into cells; every vector is routed
to its cell, and cells above ``shard_bytes`` are split by hash. Each shard has a tree of its own over all
of its vectors. Two rounds: each query searches the shards of its own cell, which bounds its k-th best
distance; then it goes to the shards of those other cells that the cell tree cannot leave out. The queries
of a shard are a stated set, searched in blocks; a task holds one shard and one block.

Inside a leaf a matrix product with a safe margin picks the rows whose distance is computed on the
original vectors, in double precision, component after component.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martforge.llm.common import grouped_rows, small_side, stored

SHARD_BYTES = 4 << 20  # of vectors in a shard, about
SAMPLE_BYTES = 16 << 20  # of vectors in the sample of the cell tree, at most
LEAF_ROWS = 512  # vectors in a leaf of a shard's tree
CELL_SAMPLE = 8  # sampled vectors in a cell, at least
QUERY_BLOCK = 2048
MAX_DEPTH = 48

_SLACK = 1e-9  # relative margin against rounding in bounds and products


def _apart(x: np.ndarray, p: np.ndarray) -> np.ndarray:
    return np.sqrt(((x - p) ** 2).sum(axis=1))


def exact_distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances of rows, squares added from the first component to the last."""
    total = np.zeros(len(a))
    for c in range(a.shape[1]):
        d = a[:, c] - b[:, c]
        total += d * d
    return np.sqrt(total)


class Node:
    """A leaf (rows), or a vantage point with the distance ranges of its two halves."""

    def __init__(self, rows: np.ndarray | None = None) -> None:
        self.rows, self.point, self.cut, self.halves, self.cell = rows, None, 0.0, (), 0

    def bounds(self, d: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least possible distance from queries at distance ``d`` to either half."""
        return tuple(np.maximum(np.maximum(lo - d, d - hi), 0.0) for lo, hi, _ in self.halves)


def grow(x: np.ndarray, leaf: int, seed: int, open_ended: bool = False) -> Node:
    """Vantage-point tree over the rows of ``x``. ``open_ended`` ranges also hold for vectors not in ``x``."""
    rng = np.random.default_rng(seed)

    def node(rows: np.ndarray, depth: int) -> Node:
        if len(rows) <= leaf or depth >= MAX_DEPTH:
            return Node(rows)
        tried, seen = rng.choice(rows, 5), rng.choice(rows, 128)
        point = x[max(tried, key=lambda r: float(np.std(_apart(x[seen], x[r]))))]  # the one that spreads the others most
        d = _apart(x[rows], point)
        cut = float(np.median(d))
        inner = d <= cut
        if inner.all():
            return Node(rows)
        out = Node()
        out.point, out.cut = point, cut
        ranges = [(0.0, cut), (cut, np.inf)] if open_ended else [(d[inner].min(), cut), (d[~inner].min(), d.max())]
        out.halves = tuple((*r, node(rows[side], depth + 1)) for r, side in zip(ranges, (inner, ~inner), strict=True))
        return out

    return node(np.arange(len(x)), 0)


class Search:
    """The k nearest rows of one shard for a block of queries, whose k-th best distances so far are ``reach``."""

    def __init__(self, x: np.ndarray, ids: np.ndarray, q: np.ndarray, own: np.ndarray, reach: np.ndarray, k: int, factor: float) -> None:
        self.x, self.ids, self.q, self.own, self.reach, self.k, self.factor = x, ids, q, own, reach.copy(), k, factor
        self.xx, self.qq = (x * x).sum(axis=1), (q * q).sum(axis=1)
        self.held = (np.empty(0, np.int64), np.empty(0), np.empty(0, np.int64))  # query, distance, id

    def go(self, node: Node, who: np.ndarray) -> None:
        if not len(who):
            return
        if node.rows is not None:
            self.compare(node.rows, who)
            return
        d = _apart(self.q[who], node.point)
        inner = d <= node.cut
        least = node.bounds(d)
        for first in (True, False):  # the half a query lies in, then the other one under the distance found there
            for side, (_, _, half) in enumerate(node.halves):
                turn = (inner == (side == 0)) == first
                near = self.factor * least[side] <= self.reach[who] * (1 + _SLACK)
                self.go(half, who[turn & near])

    def compare(self, rows: np.ndarray, who: np.ndarray) -> None:
        with np.errstate(all="ignore"):
            about = self.xx[rows][None, :] + self.qq[who][:, None] - 2 * (self.q[who] @ self.x[rows].T)
            own = self.ids[rows][None, :] == self.own[who][:, None]
            about[own] = np.inf
            margin = _SLACK * (self.qq[who] + self.xx[rows].max())
            most = self.reach[who] ** 2 + margin
            if len(rows) > self.k:
                most = np.minimum(most, np.partition(about, self.k - 1, axis=1)[:, self.k - 1] + 2 * margin)
            a, b = np.nonzero(~(about > most[:, None]) & ~own)
            a, b = who[a], rows[b]
            d = exact_distance(self.x[b], self.q[a])
        close = ~(d > self.reach[a])
        query, dist, ids = (np.concatenate(z) for z in zip(self.held, (a[close], d[close], self.ids[b[close]]), strict=True))
        order = np.lexsort((ids, dist, query))
        query, dist, ids = query[order], dist[order], ids[order]
        rank = np.arange(len(query)) - np.searchsorted(query, query)
        last = rank == self.k - 1
        self.reach[query[last]] = np.minimum(self.reach[query[last]], dist[last])
        self.held = (query[rank < self.k], dist[rank < self.k], ids[rank < self.k])


class Cells:
    """Cell trees by dimension, fitted on a sample; vectors of other dimensions are one cell."""

    def __init__(self, samples: list[list[float]], counts: dict[int, int], shard_bytes: int, seed: int) -> None:
        by_dim: dict[int, list] = {}
        for v in samples:
            by_dim.setdefault(len(v), []).append(v)
        self.trees, self.cells = {}, {}
        for dim, vs in by_dim.items():
            shards = max(1, counts[dim] * 8 * dim // shard_bytes)
            self.trees[dim] = grow(np.array(vs, np.float64), max(CELL_SAMPLE, -(-len(vs) // shards)), seed, open_ended=True)
            self.cells[dim] = self._number(self.trees[dim], 0)

    def _number(self, node: Node, n: int) -> int:
        if node.rows is not None:
            node.rows, node.cell = np.empty(0, np.int64), n
            return n + 1
        for _, _, half in node.halves:
            n = self._number(half, n)
        return n

    def home(self, x: np.ndarray) -> np.ndarray:
        """Cell of each row."""
        out = np.zeros(len(x), np.int32)

        def go(node: Node, rows: np.ndarray) -> None:
            if node.rows is not None:
                out[rows] = node.cell
            elif len(rows):
                inner = _apart(x[rows], node.point) <= node.cut
                go(node.halves[0][2], rows[inner])
                go(node.halves[1][2], rows[~inner])

        if x.shape[1] in self.trees:
            go(self.trees[x.shape[1]], np.arange(len(x)))
        return out

    def within(self, x: np.ndarray, reach: np.ndarray, factor: float) -> list[list[int]]:
        """Cells that may hold a vector within ``reach`` of each row, but for its own."""
        out: list[list[int]] = [[] for _ in x]

        def go(node: Node, rows: np.ndarray) -> None:
            if node.rows is not None:
                for r in rows.tolist():
                    out[r].append(node.cell)
            elif len(rows):
                for least, (_, _, half) in zip(node.bounds(_apart(x[rows], node.point)), node.halves, strict=True):
                    go(half, rows[factor * least <= reach[rows] * (1 + _SLACK)])

        if x.shape[1] in self.trees:
            go(self.trees[x.shape[1]], np.arange(len(x)))
        return [[c for c in cells if c != h] for cells, h in zip(out, self.home(x).tolist(), strict=True)]


def _matrices(column) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of each dimension in a list column, and their matrix."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    size = np.fromiter((len(v) for v in column), np.int64, len(column))
    start = np.cumsum(size) - size
    for dim in np.unique(size).tolist():
        rows = np.flatnonzero(size == dim)
        yield rows, flat[start[rows][:, None] + np.arange(dim)]


def _find(vectors: DataFrame, visits: DataFrame, k: int, factor: float, leaf_rows: int, seed: int) -> DataFrame:
    """query_id, vec_id, score: the k nearest of every visited shard within a query's reach.

    ``vectors``: vec_id, x, dim, cell, sub. ``visits``: query_id, x, reach, dim, cell, sub.
    """
    shard = ["dim", "cell", "sub"]
    asked = visits.groupBy(*shard).agg(F.ceil(F.count(F.lit(1)) / QUERY_BLOCK).cast("int").alias("blocks"))
    asked = small_side(stored(asked, "shard-queries"), 16)
    rows = (vectors.join(asked, shard).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .select(*shard, "block", F.lit(0).alias("role"), F.col("vec_id").alias("id"), "x", F.lit(0.0).alias("reach")))
    queries = (visits.join(asked, shard).withColumn("block", F.pmod(F.xxhash64("query_id"), F.col("blocks")).cast("int"))
               .select(*shard, "block", F.lit(1).alias("role"), F.col("query_id").alias("id"), "x", "reach"))
    together = rows.unionByName(queries).repartition(*shard, "block").sortWithinPartitions(*shard, "block")

    def search(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for t in grouped_rows(batches, 4):
            dim = t.column("dim")[0].as_py()
            x = t.column("x").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(t.num_rows, dim)
            role, ids, reach = (t.column(c).to_numpy() for c in ("role", "id", "reach"))
            order = np.argsort(ids[role == 0], kind="stable")
            there, asks = x[role == 0][order], x[role == 1]
            if not len(there):
                continue
            s = Search(there, ids[role == 0][order], asks, ids[role == 1], reach[role == 1], k, factor)
            s.go(grow(there, leaf_rows, seed), np.arange(len(asks)))
            query, dist, found = s.held
            yield pa.RecordBatch.from_arrays([pa.array(s.own[query], pa.int64()), pa.array(found, pa.int64()), pa.array(dist, pa.float64())],
                                             ["query_id", "vec_id", "score"])

    return stored(together.mapInArrow(search, "query_id long, vec_id long, score double"), "nearest")


def nearest(vectors: DataFrame, is_query: Column, k: int = 10, factor: float = 1.0, vec_id: str = "vec_id", embedding: str = "embedding",
            shard_bytes: int = SHARD_BYTES, sample_bytes: int = SAMPLE_BYTES, leaf_rows: int = LEAF_ROWS, seed: int = 11) -> DataFrame:
    """The ``k`` nearest rows, by Euclidean distance, of every row for which ``is_query`` holds.

    Returns query_id, rank (from 1), vec_id, score (the distance), nearest first, ties to the smaller vec_id.
    Candidates are all rows but those with the query's own id. Null and zero vectors, those with null or
    non-finite components and rows without an id take no part; vectors of different dimensions are not
    compared. Rows that repeat an id are candidates each; as a query, an id has its smallest vector. Empty
    tables give no rows. Only the named columns and those of ``is_query`` are read.

    ``factor`` 1 is exact; above 1 a half or cell is left out if ``factor`` times its least possible distance
    is above the k-th best found. The cell tree is fitted on the vectors of smallest digest, at most
    ``sample_bytes`` of them; every vector is indexed.
    """
    if factor < 1:
        raise ValueError("factor must be 1 (exact) or more")
    spark = vectors.sparkSession
    x = F.col(embedding).cast("array<double>")
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))) & F.exists(x, lambda c: c != 0)
    v = vectors.where(finite & F.col(vec_id).isNotNull()).select(F.col(vec_id).cast("long").alias("vec_id"), x.alias("x"), F.coalesce(is_query, F.lit(False)).alias("asks"))
    v = stored(v, "vectors")
    counts = {r["dim"]: r["count"] for r in v.groupBy(F.size("x").alias("dim")).count().collect()}  # one row per dimension
    if not counts:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    sample = max(CELL_SAMPLE, sample_bytes // (8 * max(counts)))
    fitted = [r["x"] for r in v.orderBy(F.xxhash64("vec_id", F.lit(seed)), "vec_id", "x").limit(sample).select("x").collect()]
    cells = spark.sparkContext.broadcast(Cells(fitted, counts, shard_bytes, seed))

    def place(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            cell = np.zeros(batch.num_rows, np.int32)
            for rows, m in _matrices(batch.column(1)):
                cell[rows] = cells.value.home(m)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell)], ["vec_id", "x", "asks", "cell"])

    placed = stored(v.mapInArrow(place, "vec_id long, x array<double>, asks boolean, cell int").withColumn("dim", F.size("x")), "placed-vectors")
    size = placed.groupBy("dim", "cell").agg(F.ceil(F.count(F.lit(1)) * 8 * F.col("dim") / shard_bytes).cast("int").alias("subs"))
    size = small_side(stored(size, "cells"), 16)
    sharded = placed.join(size, ["dim", "cell"]).select("vec_id", "x", "dim", "cell", F.pmod(F.xxhash64("vec_id"), F.col("subs")).cast("int").alias("sub"))
    asked = placed.where("asks").groupBy(F.col("vec_id").alias("query_id")).agg(F.min(F.struct("x", "dim", "cell")).alias("q")).select("query_id", "q.*")

    def subs(visits: DataFrame) -> DataFrame:
        return visits.join(size, ["dim", "cell"]).withColumn("sub", F.explode(F.sequence(F.lit(0), F.col("subs") - 1))).drop("subs")

    asked = stored(asked.withColumn("reach", F.lit(float("inf"))), "queries")
    first = _find(sharded, subs(asked), k, factor, leaf_rows, seed)
    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    reach = first.withColumn("rank", F.row_number().over(best)).where(F.col("rank") == k).select("query_id", F.col("score").alias("found"))
    known = asked.join(reach, "query_id", "left").select("query_id", "x", "dim", F.coalesce("found", "reach").alias("reach"))

    def spread(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            visits: list[list[int]] = [[] for _ in range(batch.num_rows)]
            reach = batch.column(3).to_numpy()
            for rows, m in _matrices(batch.column(1)):
                for r, c in zip(rows.tolist(), cells.value.within(m, reach[rows], factor), strict=True):
                    visits[r] = c
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(visits, pa.list_(pa.int32()))], ["query_id", "x", "dim", "reach", "cells"])

    more = known.mapInArrow(spread, "query_id long, x array<double>, dim int, reach double, cells array<int>").withColumn("cell", F.explode("cells")).drop("cells")
    second = _find(sharded, subs(stored(more, "visits")), k, factor, leaf_rows, seed)
    return (first.unionByName(second).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
