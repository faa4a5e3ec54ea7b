"""N-gram Jaccard self-join with a forest of signature trees.

Texts become sets of hashed word n-grams; equal sets are one node, named by its smallest doc_id. Sets
that may link meet under common roots: a set is cut by hash range into more parts than two linking
sets of its size band can differ in, so linking sets share the content of at least one part, and each
(band, part, content) is the root of a tree (:class:`Scheme`). That routing is exact for any data.

The trees are walked in two passes:

1. Every set is tried against the first set under each of its roots in its chunk of documents, and
   those against the first one of all chunks, if their sizes allow a link. These pairs grow with the
   input, not with the square of a group; their links give components.
2. Under roots that still hold more than one component, inner nodes carry the OR and AND of their
   sets' token bitmaps, their size range and their range of components. Node pairs are walked top
   down; a pair is dropped if its largest possible overlap is below what the smallest sizes need, or if
   both sides lie in one component.

Candidates of the first pass are thinned by the same bound on single bitmaps. Candidates of both passes
are then verified on the full sets: the text goes to its partners' groups, and
exact overlaps decide. Roots of any size are split into nodes of bounded size that meet pairwise in
separate groups; hubs are salted; components come from :mod:`martforge.llm.components`. Nothing is
capped or sampled, no candidate list reaches the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martforge.llm.common import grouped_rows, release, small_side, stored
from martforge.llm.components import components

NODE_SETS = 2048  # sets in a node that meets others in one group
LEAF_SETS = 32  # sets in a leaf of the tree inside a group
SALT_SETS = 512  # partners of a hub in one group
RANGE_NAMES = 1 << 19  # root names that meet in one group, about
CHUNK_NAMES = 1 << 18  # root names that a task holds before it passes them on
FAMILY_ROWS = 20_000  # sets under the roots of a family that one task walks, about
SEEN_PAIRS = 200_000  # pairs that a task remembers to hand on once
BLOCK_ROWS = 1 << 16  # rows of a packed block, or of an Arrow batch made of one

_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash, elementwise."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class WordHash(dict):
    """64-bit hashes of words, remembered up to a bounded number."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= 150_000:
            self.clear()
        h = xxhash.xxh64_intdigest(word)
        if len(word) <= 64:
            self[word] = h
        return h


_WORDS = WordHash()


def shingle_set(text: str | None, width: int = 3) -> np.ndarray:
    """Sorted hashes of the distinct word n-grams of a text; fewer words make one n-gram; no words, none."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # lowers A-Z, splits at space and U+0009 to U+000D
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(_WORDS.__getitem__, words), np.uint64, len(words))
    n = min(width, len(words))
    s = h[: len(h) - n + 1] * _A
    for k in range(1, n):
        s = mix(s + h[k: len(h) - n + 1 + k] * _B + np.uint64(k) * _C)
    return np.unique(mix(s + np.uint64(n)))


class Scheme:
    """Size bands and numbers of parts for a threshold of ``percent``.

    Sets of sizes a >= b that link differ in at most (a + b) (100 - p) / (100 + p) elements. Band i
    serves all pairs whose smaller set has a size in [low[i], low[i + 1]); its sets are cut by hash into
    more parts than they can differ in, so at least ``slack`` + 1 parts are equal in both.
    """

    def __init__(self, percent: int = 90, slack: int = 2, largest: int = 1 << 40) -> None:
        self.percent, self.slack = percent, slack
        self.low = [1]
        while self.low[-1] <= largest:
            self.low.append(max(self.low[-1] + 1, self.low[-1] * 3 // 2))
        self.differ = [self.most_apart((b := hi - 1), b * 100 // percent) for hi in self.low[1:]]

    def most_apart(self, a: int, b: int) -> int:
        return (a + b) * (100 - self.percent) // (100 + self.percent)

    def bands(self, n: int) -> list[int]:
        """Bands in which a set of size n takes part: its own, and the one below if a smaller set there can link."""
        if n < 1:
            return []
        i = int(np.searchsorted(self.low, n, side="right")) - 1
        return [i, i - 1] if i and n * self.percent <= (self.low[i] - 1) * 100 else [i]

    def count(self, n: int) -> int:
        """Roots of a set of size n, at most."""
        return sum(self.differ[b] + 1 + self.slack for b in self.bands(n) if self.differ[b])

    def keys(self, s: np.ndarray) -> np.ndarray:
        """Hashes of (band, part, elements in the part) under which the set meets its partners."""
        out = []
        for band in self.bands(len(s)):
            d = self.differ[band]
            if not d:
                continue  # only equal sets link
            parts = d + 1 + self.slack
            edges = ((np.arange(1, parts, dtype=np.float64) / parts) * 2.0**64).astype(np.uint64)
            at = np.concatenate([[0], np.searchsorted(s, edges), [len(s)]])
            total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(s ^ _C))])
            filled = at[1:] > at[:-1]
            if np.count_nonzero(~filled) > self.slack:
                filled[:] = True  # equal empty parts may be all that a pair shares
            k = mix(mix((total[at[1:]] - total[at[:-1]]) + np.arange(parts, dtype=np.uint64) * _A) + np.array([band], np.uint64) * _B)
            out.append(k[filled])
        return np.concatenate(out) if out else np.empty(0, np.uint64)


def bitmap(s: np.ndarray) -> bytes:
    """Token bitmap: eight bits per element, two in sets of 256 and more; a power of two from 64 to 131,072 bits."""
    bits = 64
    while bits < (8 if len(s) < 256 else 2) * len(s) and bits < 1 << 17:
        bits *= 2
    b = np.zeros(bits, np.uint8)
    b[(s & np.uint64(bits - 1)).astype(np.int64)] = 1
    return np.packbits(b, bitorder="little").tobytes()


def _fold(raw: bytes, words: int) -> np.ndarray:
    """Bitmap of fewer bits: the halves laid over each other."""
    return np.bitwise_or.reduce(np.frombuffer(raw, np.uint64).reshape(-1, words), axis=0)


class Node:
    """Signature-tree node over rows [lo, hi): OR and AND bitmaps, size range, component range, children."""

    def __init__(self, bits: np.ndarray, n: np.ndarray, comp: np.ndarray, lo: int, hi: int) -> None:
        self.lo, self.hi = lo, hi
        self.any = np.bitwise_or.reduce(bits[lo:hi], axis=0)
        self.all = np.bitwise_and.reduce(bits[lo:hi], axis=0)
        self.small, self.large = int(n[lo:hi].min()), int(n[lo:hi].max())
        self.comps = (int(comp[lo:hi].min()), int(comp[lo:hi].max()))
        mid = (lo + hi) // 2
        self.kids = [] if hi - lo <= LEAF_SETS else [Node(bits, n, comp, lo, mid), Node(bits, n, comp, mid, hi)]


def _needed(a, b, percent: int):
    """Smallest overlap of linking sets of sizes a and b."""
    return -(-(percent * (a + b)) // (100 + percent))


def _hopeless(x: Node, y: Node, percent: int) -> bool:
    """Whether no set of x can link with one of y that lies in another component."""
    if x.comps[0] == x.comps[1] == y.comps[0] == y.comps[1]:
        return True
    most = min(x.large - int(np.bitwise_count(x.all & ~y.any).sum()), y.large - int(np.bitwise_count(y.all & ~x.any).sum()))
    return most < _needed(x.small, y.small, percent)


def dual_walk(left: dict, right: dict | None, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows of two sides (or within one, if ``right`` is None) that may link and differ in component.

    A side has bits (rows x words), n and comp as arrays, rows in rising n.
    """
    trees = [Node(s["bits"], s["n"], s["comp"], 0, len(s["n"])) for s in (left, right) if s is not None]
    stack = [(trees[0], trees[-1])]
    other = left if right is None else right
    while stack:
        x, y = stack.pop()
        if _hopeless(x, y, percent):
            continue
        if x.kids or y.kids:
            if x is y:
                stack += [(x.kids[0], x.kids[0]), (x.kids[0], x.kids[1]), (x.kids[1], x.kids[1])]
            elif x.kids and (not y.kids or x.hi - x.lo >= y.hi - y.lo):
                stack += [(k, y) for k in x.kids]
            else:
                stack += [(x, k) for k in y.kids]
            continue
        a, b = left["bits"][x.lo:x.hi, None, :], other["bits"][None, y.lo:y.hi, :]
        na, nb = left["n"][x.lo:x.hi, None], other["n"][None, y.lo:y.hi]
        most = np.minimum(na - np.bitwise_count(a & ~b).sum(axis=2, dtype=np.int64), nb - np.bitwise_count(b & ~a).sum(axis=2, dtype=np.int64))
        ok = (most >= _needed(na, nb, percent)) & (left["comp"][x.lo:x.hi, None] != other["comp"][None, y.lo:y.hi])
        i, j = np.nonzero(ok)
        i, j = i + x.lo, j + y.lo
        if right is None:
            i, j = i[i < j], j[i < j]
        if len(i):
            yield i, j


def describe_sets(docs: DataFrame, scheme: Scheme, width: int) -> DataFrame:
    """doc_id, n, d1, d2 (digest of the set), roots (number of its roots), for every row."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in (big.slice(a, 512) for big in batches for a in range(0, big.num_rows, 512)):
            sets = [shingle_set(t, width) for t in batch.column(1).to_pylist()]
            found = {"n": [len(s) for s in sets], "d1": [int(mix(s ^ _A).sum(dtype=np.uint64).view(np.int64)) for s in sets],
                     "d2": [int(mix(s ^ _B).sum(dtype=np.uint64).view(np.int64)) for s in sets], "roots": [scheme.count(len(s)) for s in sets]}
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(x, pa.int64()) for x in found.values())], ["doc_id", *found])

    return docs.mapInArrow(run, "doc_id long, n long, d1 long, d2 long, roots long")


def _pack(*columns: np.ndarray) -> bytes:
    import zstandard

    return zstandard.ZstdCompressor(level=1).compress(b"".join([np.array([len(columns[0])]).tobytes(), *(c.astype(np.int64).tobytes() for c in columns)]))


def _unpack(block: bytes) -> np.ndarray:
    import zstandard

    flat = np.frombuffer(zstandard.ZstdDecompressor().decompress(block), np.int64)
    return flat[1:].reshape(-1, int(flat[0])) if flat[0] else flat[1:].reshape(5, 0)


def _pack_heads(key: np.ndarray, own: np.ndarray, sets: np.ndarray, n: np.ndarray) -> bytes:
    """Root names, each with the place of its set in a table of sets and sizes."""
    import zstandard

    head = np.array([len(key), len(sets)]).tobytes()
    gaps = np.diff(sets, prepend=0)
    return zstandard.ZstdCompressor(level=1).compress(head + key.tobytes() + own.astype(np.uint32).tobytes() + gaps.tobytes() + n.astype(np.int64).tobytes())


def _unpack_heads(block: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    import zstandard

    raw = zstandard.ZstdDecompressor().decompress(block)
    names, sets = np.frombuffer(raw, np.int64, 2).tolist()
    key = np.frombuffer(raw, np.uint64, names, 16)
    own = np.frombuffer(raw, np.uint32, names, 16 + 8 * names)
    gaps, n = (np.frombuffer(raw, np.int64, sets, 16 + 12 * names + 8 * sets * k) for k in (0, 1))
    return key, np.cumsum(gaps)[own], n[own]


def _edges(names: np.ndarray) -> np.ndarray:
    """Where runs of equal names begin, and the end."""
    return np.concatenate([[0], np.flatnonzero(names[1:] != names[:-1]) + 1, [len(names)]])


def meet_under_roots(docs: DataFrame, scheme: Scheme, width: int, names: int, chunk: int = CHUNK_NAMES, per_range: int = RANGE_NAMES) -> DataFrame:
    """key, rep, n, head, head_n: the sets under every root that holds several, each with a set tried first.

    ``docs``: doc_id, text; ``names``: number of roots in all. Roots go to ranges of about ``per_range``
    names, packed in one block per range and chunk of documents. A chunk ships a root once, however many
    of its sets are under it: those meet their first one there, and only it goes on to the range, where the
    first ones of all chunks meet. So a root under which a third of all sets lie costs one entry a chunk.
    """
    ranges = max(8, -(-names // per_range))

    def route(batches: Iterator) -> Iterator:
        import pyarrow as pa

        keys, reps, held = [], [], 0

        def blocks():
            key = np.concatenate(keys)
            size = np.array([len(k) for k in keys])
            rep, n = (np.repeat(np.array(c, np.int64), size) for c in zip(*reps, strict=True))
            order = np.lexsort((rep, key))
            key, rep, n = key[order], rep[order], n[order]
            edges = _edges(key)
            first, count = edges[:-1], np.diff(edges)
            many = np.repeat(count > 1, count)
            head = np.repeat(first, count)
            out = []
            mine = np.flatnonzero(many)
            for a in range(0, len(mine), BLOCK_ROWS):  # done here: any task may hand them on
                part = mine[a:a + BLOCK_ROWS]
                out.append((-1 - int(key[part[0]] % np.uint64(ranges)), _pack(key[part].view(np.int64), rep[part], n[part], rep[head[part]], n[head[part]])))
            key, rep, n = key[first], rep[first], n[first]
            at = ((key >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32)
            cuts = _edges(at)
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                sets, index = np.unique(rep[a:b], return_index=True)
                own = np.searchsorted(sets, rep[a:b])
                out.append((int(at[a]), _pack_heads(key[a:b], own, sets, n[a:b][index])))
            return pa.RecordBatch.from_arrays([pa.array([x for x, _ in out], pa.int64()), pa.array([x for _, x in out], pa.binary())], ["range", "block"])

        for batch in (big.slice(a, 512) for big in batches for a in range(0, big.num_rows, 512)):
            for doc, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                s = shingle_set(t, width)
                k = scheme.keys(s)
                if len(k):
                    keys.append(k)
                    reps.append((doc, len(s)))
                    held += len(k)
            if held >= chunk:
                yield blocks()
                keys, reps, held = [], [], 0
        if held:
            yield blocks()

    def meet(batches: Iterator) -> Iterator:
        import pyarrow as pa

        def rows(key, rep, n, head, head_n):
            for a in range(0, len(key), BLOCK_ROWS):
                yield pa.RecordBatch.from_arrays([pa.array(c[a:a + BLOCK_ROWS], pa.int64()) for c in (key, rep, n, head, head_n)], ["key", "rep", "n", "head", "head_n"])

        def together(parts):
            key, rep, n = (np.concatenate(c) for c in zip(*parts, strict=True))
            order = np.lexsort((rep, key))
            edges = _edges(key[order])
            count = np.diff(edges)
            many = np.repeat(count > 1, count)
            head = order[np.repeat(edges[:-1], count)[many]]
            own = order[many]
            yield from rows(key[own].view(np.int64), rep[own], n[own], rep[head], n[head])

        parts, of = [], None
        for batch in batches:
            for at, block in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if at < 0:
                    yield from rows(*_unpack(block))
                    continue
                if at != of and parts:
                    yield from together(parts)
                    parts = []
                of = at
                parts.append(_unpack_heads(block))
        if parts:
            yield from together(parts)

    packed = docs.mapInArrow(route, "range long, block binary").repartition("range").sortWithinPartitions("range")
    return packed.mapInArrow(meet, "key long, rep long, n long, head long, head_n long")


def token_bitmaps(docs: DataFrame, reps: DataFrame, width: int) -> DataFrame:
    """rep, n, bits for the sets named in ``reps`` (doc_id)."""
    def maps(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in (big.slice(a, 512) for big in batches for a in range(0, big.num_rows, 512)):
            s = [shingle_set(t, width) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(x) for x in s], pa.int64()), pa.array([bitmap(x) for x in s], pa.binary())],
                                             ["rep", "n", "bits"])

    named = docs.join(small_side(reps, 16), "doc_id", "left_semi").select("doc_id", "text")
    return stored(named.mapInArrow(maps, "rep long, n long, bits binary"), "set-bitmaps")


def _most(x: tuple, y: tuple) -> int:
    """Largest possible overlap of two sets (n, bitmap)."""
    words = min(len(x[1]), len(y[1])) // 8
    a, b = _fold(x[1], words), _fold(y[1], words)
    return min(x[0] - int(np.bitwise_count(a & ~b).sum()), y[0] - int(np.bitwise_count(b & ~a).sum()))


def _around_hubs(pairs: DataFrame) -> DataFrame:
    """doc_id, hub, salt, role: every b of pairs (a, b) is a hub (role 0); it meets about SALT_SETS partners in a group."""
    degree = pairs.groupBy("b").agg(F.ceil(F.count(F.lit(1)) / SALT_SETS).alias("salts"))
    m = pairs.join(degree, "b").withColumn("salt", F.pmod(F.xxhash64("a"), F.col("salts")))
    return stored(m.select(F.col("a").alias("doc_id"), F.col("b").alias("hub"), "salt", F.lit(1).alias("role"))
                  .unionByName(m.select(F.col("b").alias("doc_id"), F.col("b").alias("hub"), "salt", F.lit(0).alias("role")).distinct()), "set-groups")


def promising(pairs: DataFrame, maps: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose bitmaps leave room for a link: what is left out cannot link."""
    meet = _around_hubs(pairs)

    def check(batches: Iterator) -> Iterator:
        import pyarrow as pa

        group, hubs = None, []
        for batch in batches:
            a, b = [], []
            for hub, salt, role, doc, n, bits in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (hub, salt) != group:
                    group, hubs = (hub, salt), []
                if role == 0:
                    hubs.append((n, bits))
                elif any(_most((n, bits), h) >= _needed(n, h[0], percent) for h in hubs):
                    a.append(doc)
                    b.append(hub)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    together = (meet.join(maps.withColumnRenamed("rep", "doc_id"), "doc_id").select("hub", "salt", "role", "doc_id", "n", "bits")
                .repartition("hub", "salt").sortWithinPartitions("hub", "salt", "role"))
    kept = stored(together.mapInArrow(check, "a long, b long").distinct(), "promising-pairs")
    release(meet)
    return kept


def verify(docs: DataFrame, pairs: DataFrame, percent: int, width: int) -> DataFrame:
    """Pairs (a, b) of doc_ids whose sets link, by exact overlap.

    Every b is a hub: its set and the sets of its partners meet in groups of about SALT_SETS partners.
    """
    pairs = stored(pairs, "set-pairs")
    meet = _around_hubs(pairs)

    def sets(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in (big.slice(a, 512) for big in batches for a in range(0, big.num_rows, 512)):
            found = [shingle_set(t, width).tobytes() for t in batch.column(4).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(found, pa.binary())], ["hub", "salt", "role", "doc_id", "s"])

    def check(batches: Iterator) -> Iterator:
        import pyarrow as pa

        group, hubs = None, []
        for batch in batches:
            a, b = [], []
            for hub, salt, role, doc, raw in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (hub, salt) != group:
                    group, hubs = (hub, salt), []
                s = np.frombuffer(raw, np.uint64)
                if role == 0:
                    hubs.append(s)
                    continue
                for h in hubs:
                    need = _needed(len(s), len(h), percent)
                    if min(len(s), len(h)) >= max(need, 1):
                        at = np.minimum(np.searchsorted(h, s), len(h) - 1)
                        if np.count_nonzero(h[at] == s) >= need:
                            a.append(doc)
                            b.append(hub)
                            break
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    texts = docs.join(small_side(meet, 32), "doc_id").select("hub", "salt", "role", "doc_id", "text")
    together = (texts.mapInArrow(sets, "hub long, salt long, role int, doc_id long, s binary")
                .repartition("hub", "salt").sortWithinPartitions("hub", "salt", "role"))
    found = stored(together.mapInArrow(check, "a long, b long").distinct(), "set-links")
    release(pairs, meet)
    return found


def walk_roots(about: DataFrame, rows: DataFrame, percent: int) -> DataFrame:
    """Candidate pairs (a, b) under roots with several components, by walking their signature trees.

    ``rows``: key, rep, comp: the sets under such roots; ``about``: rep, n, bits. Similar sets meet under many
    roots: roots with the same smallest set are a family, whose roots go to as few tasks as their size
    allows, and a task hands a pair on once.
    """
    family = rows.groupBy("key").agg(F.min("rep").alias("family"), F.count(F.lit(1)).alias("c"))
    spread = family.groupBy("family").agg(F.ceil(F.sum("c") / FAMILY_ROWS).alias("places"))
    family = stored(family.join(spread, "family"), "families")
    # Nodes of bounded size: by component, and within a large component by set.
    size = rows.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / NODE_SETS).alias("cells"))
    part = rows.groupBy("key", "comp").agg(F.ceil(F.count(F.lit(1)) / NODE_SETS).alias("slices"))
    placed = (rows.join(size, "key").join(part, ["key", "comp"]).withColumn("node", F.struct(
        F.pmod(F.xxhash64("comp"), F.col("cells")).alias("cell"), F.pmod(F.xxhash64("rep"), F.col("slices")).alias("slice")))
        .select("key", "rep", "comp", "node"))
    placed = stored(placed, "tree-nodes")
    nodes = placed.join(about.select("rep", "n"), "rep").groupBy("key", "node").agg(
        F.min("comp").alias("c0"), F.max("comp").alias("c1"), F.min("n").alias("n0"), F.max("n").alias("n1"))
    x, y = nodes.alias("x"), nodes.alias("y")
    met = (x.join(y, (F.col("x.key") == F.col("y.key")) & (F.col("x.node") <= F.col("y.node"))
                  & (F.col("x.n0") * percent <= F.col("y.n1") * 100) & (F.col("y.n0") * percent <= F.col("x.n1") * 100)
                  & ~((F.col("x.c0") == F.col("x.c1")) & (F.col("y.c0") == F.col("y.c1")) & (F.col("x.c0") == F.col("y.c0"))))
           .select(F.col("x.key").alias("key"), F.col("x.node").alias("left"), F.col("y.node").alias("right")))
    met = stored(met, "node-pairs")
    one = met.withColumn("node", F.col("left")).withColumn("side", F.lit(0))
    two = met.where("left != right").withColumn("node", F.col("right")).withColumn("side", F.lit(1))
    sides = placed.join(one.unionByName(two), ["key", "node"]).select("key", F.xxhash64("left", "right").alias("pair"), "side", "rep", "comp")
    spot = F.when(F.col("c") > NODE_SETS, F.xxhash64("key", "pair")).otherwise(F.xxhash64("key"))  # a large root is spread as well
    sides = sides.join(family, "key").select("key", "pair", "side", "rep", "comp", "family", F.pmod(spot, F.col("places")).alias("place"))
    group = (sides.join(about, "rep").select("key", "pair", "side", "rep", "comp", "n", "bits", "family", "place")
             .repartition("family", "place").sortWithinPartitions("family", "place", "key", "pair"))

    def walk(batches: Iterator) -> Iterator:
        import pyarrow as pa

        seen: set = set()
        for t in grouped_rows(batches, 2):
            c = {k: t.column(k).to_numpy() for k in ("side", "rep", "comp", "n")}
            raw = t.column("bits").to_pylist()
            words = min(len(b) for b in raw) // 8
            found = []
            for k in (0, 1):
                order = np.lexsort((c["rep"], c["n"], c["side"] != k))[: int((c["side"] == k).sum())]
                found.append(None if not len(order) else {"n": c["n"][order], "comp": c["comp"][order], "rep": c["rep"][order],
                                                         "bits": np.stack([_fold(raw[i], words) for i in order])})
            left, right = found
            if left is None:
                continue
            other = left if right is None else right
            a, b = [], []
            for i, j in dual_walk(left, right, percent):
                u, v = left["rep"][i], other["rep"][j]
                for p in zip(np.maximum(u, v).tolist(), np.minimum(u, v).tolist(), strict=True):
                    if p not in seen:
                        seen.add(p)
                        a.append(p[0])
                        b.append(p[1])
            if len(seen) > SEEN_PAIRS:
                seen.clear()
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return group.mapInArrow(walk, "a long, b long")


def ngram_components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 3, percent: int = 90, slack: int = 2) -> DataFrame:
    """Components of the similarity graph of whole texts.

    Two documents link if 100 * |intersection| >= ``percent`` * |union| of their word ``width``-gram
    sets. Returns one row per row of ``docs``: doc_id, n_shingles, component_id (smallest doc_id
    reachable). Null or wordless texts have no set and link with nothing; texts with fewer than
    ``width`` words have one element. A null doc_id links with nothing and has a null component_id. Rows
    that repeat a doc_id are one document: it links as any of its texts does. An empty table gives no
    rows. Only the two columns are read; doc_id must be an integer type.
    """
    scheme = Scheme(percent, slack)
    d = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    about = stored(describe_sets(d, scheme, width), "sets")
    linkable = about.where("n > 0 and doc_id is not null")
    first = linkable.groupBy("d1", "d2", "n").agg(F.min("doc_id").alias("rep"), F.max("roots").alias("roots"))
    member = stored(linkable.select("doc_id", "d1", "d2", "n").join(first, ["d1", "d2", "n"]).select("doc_id", "rep", "roots").distinct(), "set-members")
    # A doc_id with several texts ties their sets together.
    tied = (member.withColumn("b", F.min("rep").over(Window.partitionBy("doc_id"))).where("rep != b").select(F.col("rep").alias("a"), "b"))
    # One text of each set is routed: those with a doc_id that names no set stay behind.
    names = member.where("doc_id = rep").agg(F.coalesce(F.sum("roots"), F.lit(0))).first()[0]
    behind = member.groupBy("doc_id").agg(F.max((F.col("doc_id") == F.col("rep")).cast("int")).alias("names")).where("names = 0").select("doc_id")
    fresh = d.where("doc_id is not null").join(small_side(stored(behind, "set-copies"), 16), "doc_id", "left_anti").select("doc_id", "text")
    # Pass 1: the first set under each root against the others there.
    shared = stored(meet_under_roots(fresh, scheme, width, names), "roots")
    sized = (F.col("n") * percent <= F.col("head_n") * 100) & (F.col("head_n") * percent <= F.col("n") * 100)
    tried = shared.where((F.col("rep") != F.col("head")) & sized).select(F.col("rep").alias("a"), F.col("head").alias("b")).distinct()
    maps = token_bitmaps(d, shared.select(F.col("rep").alias("doc_id")).distinct(), width)
    links = verify(d, promising(stored(tried, "tried-pairs"), maps, percent), percent, width)
    # Pass 2: roots with more than one component left; a root of two sets has been decided.
    comp = components(links)
    many = shared.join(comp.select(F.col("id").alias("rep"), "component_id"), "rep", "left").select(
        "key", "rep", F.coalesce("component_id", "rep").alias("comp"))
    many = stored(many.distinct(), "open-sets")
    release(shared)
    # Roots over the same sets are one tree: the first key stands for all.
    open_roots = (many.groupBy("key").agg(F.min("comp").alias("c0"), F.max("comp").alias("c1"), F.count(F.lit(1)).alias("c"),
                                          F.bit_xor(F.xxhash64("rep")).alias("x0"), F.bit_xor(F.xxhash64("rep", F.lit(1))).alias("x1"))
                  .where("c0 != c1 and c > 2").groupBy("c", "x0", "x1").agg(F.min("key").alias("key")).select("key"))
    rows = stored(many.join(open_roots, "key", "left_semi"), "open-roots")
    release(many)
    more = verify(d, walk_roots(maps, rows, percent).where("a != b").distinct(), percent, width)
    release(rows, maps)
    final = components(links.unionByName(more).unionByName(tied))
    named = member.join(final.select(F.col("id").alias("rep"), "component_id"), "rep", "left").select(
        "doc_id", F.coalesce("component_id", "rep").alias("component_id")).groupBy("doc_id").agg(F.min("component_id").alias("component_id"))
    # A doc_id may be smaller than the centre only within its own component, so the smallest name stands.
    return (about.select("doc_id", F.col("n").alias("n_shingles")).join(named, "doc_id", "left")
            .select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")))
