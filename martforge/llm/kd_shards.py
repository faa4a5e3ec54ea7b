"""Sharding by k-d tree partitioning over document metadata.

All rows start in one node that stands for all shards. Level by level, each node with more than one
shard is cut along its widest metadata dimension at the weighted quantile that gives the left child
its share of the bytes (half of the shards, rounded down). The tree ends when every node stands for
one shard, so leaves differ by little more than the documents at the cuts.

A coordinate is a 48-bit number: 16 bits of the dimension and 32 bits of a digest of the row, so
that rows with equal metadata still have an order and no cut is blocked by ties. The quantile of all
nodes of a level is found together in four distributed histograms of 4,096 bins each (12 bits a
round), summed up on the map side; per round only one row per node reaches the driver. The driver holds
the cuts (one per inner node), never rows. Rows carry ids and sizes, no texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martforge.llm.common import ranked, stored

_BITS = 12
_ROUNDS = 4


def log_scale(x: Column, steps: int = 1024) -> Column:
    """Non-negative number on a logarithmic scale of 16 bits."""
    return F.least(F.floor(F.log2(x.cast("double") + 1) * steps), F.lit(65535)).cast("long")


def hash_scale(x: Column) -> Column:
    """Category on a 16-bit scale: its place does not matter, only that equal values fall together."""
    return F.pmod(F.xxhash64(x), F.lit(65536))


def coordinate(value: Column, tie: Column) -> Column:
    """48-bit coordinate: the 16-bit value first, the 32-bit digest behind."""
    return F.shiftleft(value.cast("long"), 32) + tie


class Tree:
    """Cuts found so far. Nodes are numbered like a heap: root 1, children 2k and 2k + 1."""

    def __init__(self, shards: int) -> None:
        self.low, self.n = {1: 0}, {1: shards}  # first shard and number of shards of a node
        self.dim: dict[int, int] = {}
        self.cut: dict[int, int] = {}
        self.depth = 0

    def split(self, node: int, dim: int, cut: int) -> None:
        """Rows of ``node`` whose coordinate is below ``cut`` go left."""
        self.dim[node], self.cut[node] = dim, cut
        half = self.n[node] // 2
        self.low |= {2 * node: self.low[node], 2 * node + 1: self.low[node] + half}
        self.n |= {2 * node: half, 2 * node + 1: self.n[node] - half}
        self.depth = max(self.depth, node.bit_length())

    def place(self, points: DataFrame, dims: int) -> DataFrame:
        """Add the column node: one walk down the tree per row."""
        if not self.depth:
            return points.withColumn("node", F.lit(1))
        at = F.array(*[F.col(f"d{i}") for i in range(dims)])
        dim, cut = _literal(self.dim, "int"), _literal(self.cut, "long")

        def step(node: Column, _: Column) -> Column:
            right = F.get(at, F.get(dim, node)) >= F.get(cut, node)
            return F.when(right.isNull(), node).otherwise(node * 2 + right.cast("int"))

        return points.withColumn("node", F.aggregate(F.array(*[F.lit(i) for i in range(self.depth)]), F.lit(1), step))


def _literal(values: dict[int, object], kind: str) -> Column:
    """Literal array of per-node numbers, null for nodes without one. There are fewer nodes than 4 x shards."""
    return F.array(*[F.lit(values.get(i)).cast(kind) for i in range(max(values, default=0) + 1)])


def _by_node(values: dict[int, object], kind: str) -> Column:
    return F.get(_literal(values, kind), F.col("node"))


def grow(points: DataFrame, dims: int, shards: int) -> Tree:
    """Tree with one leaf per shard over ``points``: d0 .. d{dims-1} (48-bit coordinates) and size."""
    tree = Tree(shards)
    open_nodes = [1] if shards > 1 else []
    while open_nodes:
        placed = tree.place(points, dims).where(F.col("node").isin(open_nodes))
        extents = placed.groupBy("node").agg(
            F.sum("size").alias("bytes"),
            *[(F.max(F.shiftright(f"d{i}", 32)) - F.min(F.shiftright(f"d{i}", 32))).alias(f"w{i}") for i in range(dims)]).collect()
        if not extents:
            break
        dim = {r["node"]: max(range(dims), key=lambda i: (r[f"w{i}"], -i)) for r in extents}  # noqa: B023
        want = {r["node"]: r["bytes"] * (tree.n[r["node"]] // 2) / tree.n[r["node"]] for r in extents}
        prefix, below = dict.fromkeys(dim, 0), dict.fromkeys(dim, 0)
        upto = dict(below)
        x = placed.select("node", "size", F.get(F.array(*[F.col(f"d{i}") for i in range(dims)]), _by_node(dim, "int")).alias("x"))
        for k in range(_ROUNDS):
            shift = _BITS * (_ROUNDS - 1 - k)
            bins = (x.where(F.shiftright("x", shift + _BITS) == _by_node(prefix, "long"))
                    .groupBy("node", F.shiftright("x", shift).alias("bin")).agg(F.sum("size").alias("s")))
            rising = Window.partitionBy("node").orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
            reached = (bins.withColumn("upto", F.sum("s").over(rising))
                       .where(F.col("upto") > _by_node({n: want[n] - below[n] for n in dim}, "double"))
                       .groupBy("node").agg(F.min(F.struct("bin", "s", "upto")).alias("h")))
            for r in reached.collect():  # one row per open node
                n, h = r["node"], r["h"]
                prefix[n], upto[n] = h["bin"], below[n] + h["upto"]
                below[n] += h["upto"] - h["s"]
        for n in dim:  # the last bin goes to the side that comes nearer
            tree.split(n, dim[n], prefix[n] + (upto[n] - want[n] < want[n] - below[n]))
        open_nodes = [c for n in dim for c in (2 * n, 2 * n + 1) if tree.n[c] > 1]
    return tree


def kd_shards(docs: DataFrame, doc_id: Column, text: Column, metadata: list[Column], shards: int = 40) -> DataFrame:
    """Shard of every row, sizes near equal.

    ``metadata``: dimensions as 16-bit numbers (see :func:`log_scale`, :func:`hash_scale`). Returns
    doc_id, size (UTF-8 bytes of the text and 16), text_crc32, shard (0 to shards - 1) and slot (0, 1,
    ... within the shard, by a digest of the id). Null text has no bytes; a null dimension counts
    as 0 (``hash_scale`` gives null a number of its own); repeated rows are placed one by one; with fewer rows than shards, some shards
    stay empty; an empty table gives no rows. Only the given expressions are read.
    """
    t = F.coalesce(text, F.lit(""))
    points = docs.select(doc_id.alias("doc_id"), (F.octet_length(t) + 16).cast("long").alias("size"), F.crc32(F.encode(t, "UTF-8")).alias("text_crc32"),
                         *[F.coalesce(m, F.lit(0)).cast("long").alias(f"m{i}") for i, m in enumerate(metadata)])
    points = points.withColumn("tie", F.xxhash64("doc_id", "text_crc32").bitwiseAND(0xFFFFFFFF))
    points = stored(points.select("doc_id", "size", "text_crc32", "tie", *[coordinate(F.col(f"m{i}"), F.col("tie")).alias(f"d{i}") for i in range(len(metadata))]), "kd-points")
    tree = grow(points, len(metadata), shards)
    placed = tree.place(points, len(metadata)).withColumn("shard", _by_node(tree.low, "int")).withColumn("part", F.col("tie") % 1024)
    return ranked(placed, ["shard"], ["part"], ["tie", "doc_id", "text_crc32"], "slot").select("doc_id", "size", "text_crc32", "shard", "slot")
