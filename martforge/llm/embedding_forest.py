"""Embedding near-dedup with a forest of random-projection trees.

Each tree has one random direction per level; a node is cut at the median of its sample along it, and
vectors near the cut go to both sides (spill). Cuts are fitted on a bounded sample of the distinct
vectors (``sample`` of them, those with the smallest digests); every vector is routed through every
tree. Vectors within a leaf are compared by cosine in double precision. A pair is counted in its
first common leaf of the forest only, so counts of different leaves add up.

Equal vectors are one class with a multiplicity, so groups of copies cost one row. A leaf of any size
is split into blocks that meet pairwise; a block pair emits one count per vector and a spanning set of
links, never its pairs. Only the fitted cuts are sent to the tasks: at most ``sample`` numbers per tree.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martforge.llm.common import grouped_rows, stored
from martforge.llm.components import components

BLOCK = 2048  # vectors of a leaf that meet others in one group


class Tree:
    """Cuts of one tree for one dimension: heap-ordered medians and spill margins per level."""

    def __init__(self, x: np.ndarray, leaf: int, spill: float, seed: tuple[int, ...]) -> None:
        rng, self.directions, self.cuts = np.random.default_rng(seed), [], []
        members = {0: np.arange(len(x))}
        while any(len(m) > leaf for m in members.values()):
            u = rng.standard_normal(x.shape[1])
            u /= np.linalg.norm(u)
            at, cuts, below = x @ u, {}, {}
            for node, m in members.items():
                if len(m) <= leaf:
                    continue
                p = at[m]
                lo, mid, hi = np.quantile(p, [0.5 - spill, 0.5, 0.5 + spill])
                if p.min() == p.max():
                    continue
                cuts[node] = (lo, mid, hi)
                below[2 * node + 1], below[2 * node + 2] = m[p <= mid], m[p > mid]
            if not cuts:
                break
            self.directions.append(u)
            self.cuts.append(cuts)
            members = below

    def leaves(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row numbers and leaf nodes; a row appears once per leaf it spills into."""
        rows, nodes = np.arange(len(x)), np.zeros(len(x), np.int64)
        done: list[tuple[np.ndarray, np.ndarray]] = []
        for u, cuts in zip(self.directions, self.cuts, strict=True):
            keys = np.array(sorted(cuts), np.int64)
            k = np.minimum(np.searchsorted(keys, nodes), len(keys) - 1)
            inner = keys[k] == nodes
            done.append((rows[~inner], nodes[~inner]))
            rows, nodes, k = rows[inner], nodes[inner], k[inner]
            lo, _, hi = np.array([cuts[n] for n in keys.tolist()]).T
            at = x[rows] @ u
            left, right = at <= hi[k], at > lo[k]
            rows, nodes = np.concatenate([rows[left], rows[right]]), np.concatenate([2 * nodes[left] + 1, 2 * nodes[right] + 2])
        done.append((rows, nodes))
        return np.concatenate([r for r, _ in done]), np.concatenate([n for _, n in done])


class Forest:
    """Trees by dimension; vectors of a dimension without trees share one leaf."""

    def __init__(self, samples: list[list[float]], total: int, trees: int, leaf_rows: int, spill: float, seed: int) -> None:
        by_dim: dict[int, list] = {}
        for v in samples:
            by_dim.setdefault(len(v), []).append(v)
        leaf = max(8, round(leaf_rows * len(samples) / max(1, total)))
        self.trees = {}
        for dim, vs in sorted(by_dim.items()):
            x = np.array(vs, np.float64)
            x /= np.linalg.norm(x, axis=1, keepdims=True)
            self.trees[dim] = [Tree(x, leaf, spill, (seed, dim, t)) for t in range(trees)]

    def codes(self, vectors: list[np.ndarray]) -> list[list[int]]:
        """Leaf codes of each vector, rising; trees and dimensions have codes of their own."""
        out: list[list[int]] = [[] for _ in vectors]
        dims: dict[int, list[int]] = {}
        for i, v in enumerate(vectors):
            dims.setdefault(len(v), []).append(i)
        for dim, own in dims.items():
            if dim not in self.trees:
                for i in own:
                    out[i].append(dim << 40)
                continue
            x = np.stack([vectors[i] for i in own])
            x = x / np.linalg.norm(x, axis=1, keepdims=True)
            for t, tree in enumerate(self.trees[dim]):
                rows, nodes = tree.leaves(x)
                for r, n in zip(rows.tolist(), nodes.tolist(), strict=True):
                    out[own[r]].append((dim << 40) + (t << 32) + n)
        return [sorted(c) for c in out]


def _roots(linked: np.ndarray) -> np.ndarray:
    """Smallest row of each row's component in a symmetric link matrix."""
    label = np.arange(len(linked))
    while True:
        least = np.where(linked, label[None, :], len(label)).min(axis=1, initial=len(label))
        new = np.minimum(label, least)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _meet(a: dict, b: dict | None, code: int, least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Links of two blocks (or of one, if ``b`` is None) whose first common leaf is ``code``.

    Returns vectors with their linked multiplicity, and spanning links.
    """
    o = a if b is None else b
    cos = (a["x"] @ o["x"].T) / (a["norm"][:, None] * o["norm"][None, :])
    hit = cos >= least
    if b is None:
        np.fill_diagonal(hit, False)
    if hit.any():
        earlier = sorted({c for s in a["codes"] for c in s if c < code} & {c for s in o["codes"] for c in s if c < code})
        if earlier:
            place = {c: k for k, c in enumerate(earlier)}

            def marks(side: dict) -> np.ndarray:
                m = np.zeros((len(side["codes"]), len(earlier)), np.float32)
                for r, s in enumerate(side["codes"]):
                    m[r, [place[c] for c in s if c in place]] = 1
                return m

            hit &= (marks(a) @ marks(o).T) == 0
    if b is None:
        ids, got = a["rep"], hit @ a["mult"]
        linked = hit
    else:
        ids, got = np.concatenate([a["rep"], o["rep"]]), np.concatenate([hit @ o["mult"], hit.T @ a["mult"]])
        n, m = hit.shape
        linked = np.zeros((n + m, n + m), bool)
        linked[:n, n:], linked[n:, :n] = hit, hit.T
    some = np.flatnonzero(got)
    if not len(some):
        return ids[:0], got[:0], ids[:0], ids[:0]
    root = some[_roots(linked[np.ix_(some, some)])]
    own = some != root
    return ids[some], got[some], ids[some][own], ids[root[own]]


def near_duplicates(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", least: float = 0.95, trees: int = 10,
                    sample: int = 20_000, leaf_rows: int = 500, spill: float = 0.06, seed: int = 7) -> DataFrame:
    """Links by cosine >= ``least`` found through the forest.

    Returns one row per row: vec_id, n_links (other vectors linked directly), component_id (smallest
    vec_id reachable), kept (vec_id = component_id). Null and zero vectors and those with null or
    non-finite components link with nothing, as do vectors of different dimensions with each other. A
    null vec_id links with nothing, has no component_id and is kept. Rows that repeat a vec_id are one
    node whose links add up. An empty table gives no rows. Only the two columns are read.
    """
    spark = vectors.sparkSession
    v = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).cast("array<double>").alias("x"))
    finite = F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))) & F.exists("x", lambda c: c != 0)
    v = stored(v.withColumn("x", F.when(F.col("vec_id").isNotNull() & finite, F.col("x"))), "vectors")
    sound = v.where("x is not null")
    classes = stored(sound.groupBy("x").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("mult")), "vector-classes")
    total = classes.count()
    # The documented sample: distinct vectors with the smallest digests.
    fitted = [r["x"] for r in classes.orderBy(F.xxhash64("rep", F.lit(seed)), "rep").limit(sample).select("x").collect()]
    forest = spark.sparkContext.broadcast(Forest(fitted, total, trees, leaf_rows, spill, seed))

    def route(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            lists = batch.column(2)
            flat, ends = lists.flatten().to_numpy(zero_copy_only=False), np.cumsum([0, *(len(x) for x in lists)])
            codes = forest.value.codes([flat[i:j] for i, j in zip(ends[:-1], ends[1:], strict=True)])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(codes, pa.list_(pa.int64()))], ["rep", "mult", "x", "codes"])

    routed = stored(classes.select("rep", "mult", "x").mapInArrow(route, "rep long, mult long, x array<double>, codes array<long>"), "routed")
    at = routed.select("*", F.explode("codes").alias("code"))
    full = at.groupBy("code").agg(F.count(F.lit(1)).alias("c")).where("c > 1").withColumn("blocks", F.ceil(F.col("c") / BLOCK).cast("int")).drop("c")
    placed = at.join(full, "code").withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    met = (placed.withColumn("other", other)
           .select("code", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
                   (F.col("block") > F.col("other")).cast("int").alias("side"), "rep", "mult", "x", "codes")
           .repartition("code", "i", "j").sortWithinPartitions("code", "i", "j"))

    def compare(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for t in grouped_rows(batches, 3):
            code, i, j = (t.column(k)[0].as_py() for k in range(3))
            side = t.column("side").to_numpy()
            rep, mult, codes = t.column("rep").to_numpy(), t.column("mult").to_numpy().astype(np.float64), t.column("codes").to_pylist()
            x = t.column("x").combine_chunks()
            x = x.flatten().to_numpy(zero_copy_only=False).reshape(len(x), -1)
            blocks = []
            for k in (0, 1):
                own = np.flatnonzero(side == k)
                blocks.append({"rep": rep[own], "mult": mult[own], "x": x[own], "norm": np.linalg.norm(x[own], axis=1), "codes": [codes[r] for r in own]})
            if i != j and not (len(blocks[0]["rep"]) and len(blocks[1]["rep"])):
                continue
            ids, got, a, b = _meet(blocks[0], None if i == j else blocks[1], code, least)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([ids, a])), pa.array(np.concatenate([got.astype(np.int64), np.zeros(len(a), np.int64)])),
                 pa.array(np.concatenate([ids, b]))], ["a", "n", "b"])

    found = stored(met.mapInArrow(compare, "a long, n long, b long"), "vector-links")
    counts = found.groupBy("a").agg(F.sum("n").alias("others"))
    member = sound.join(classes, "x").select("vec_id", "rep", "mult")
    tied = member.withColumn("b", F.min("rep").over(Window.partitionBy("vec_id"))).where("rep != b").select(F.col("rep").alias("a"), "b")
    comp = components(found.where("a != b").select("a", "b").unionByName(tied))
    told = (member.join(counts.select(F.col("a").alias("rep"), "others"), "rep", "left").join(comp.withColumnRenamed("id", "rep"), "rep", "left")
            .select("vec_id", (F.col("mult") - 1 + F.coalesce("others", F.lit(0))).alias("n"), F.coalesce("component_id", "rep").alias("component_id"))
            .groupBy("vec_id").agg(F.max("n").alias("n_links"), F.min("component_id").alias("component_id")))
    return v.select("vec_id").join(told, "vec_id", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"),
        (F.coalesce("component_id", "vec_id").eqNullSafe(F.col("vec_id"))).alias("kept"))
