"""Ranked lexical search of items in whole texts, by one Aho-Corasick scan of the documents.

Terms are runs of ASCII letters, digits and characters beyond ASCII, with A-Z lowered. All terms of the
items go into one automaton, each between two boundary marks, and every text is brought to the form
mark-term-mark-term-mark; so a match is a whole term, neighbours share a mark, and the scan counts term
frequencies straight from the text. No index of the documents is built: per document there is one row
with its length and the counts of the items' own terms.

Two steps. The scan gives the rows; from them come the corpus counts (documents, terms, documents per
term). Scoring maps the automaton's outputs to the items that hold the term, adds up scores, and keeps
the best of each item per task; the final ranks come in two rounds, first within salts.

Items are a query set. They are dealt to shards whose terms stay below ``automaton_bytes`` (or are those
of one item); shards are scanned one after the other, and only a shard's terms are sent to the tasks.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce
from operator import itemgetter

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martforge.llm.common import release, stored

AUTOMATON_BYTES = 2 << 20  # of terms in one automaton
SHARD_ITEMS = 2048
SALTS = 32  # parts of an item's candidates in the first ranking round

#: Byte table of a text in UTF-8: separators become the boundary mark (a blank), A-Z become a-z, the rest stays.
_KEEP = bytes(b for b in range(256) if b >= 0x80 or chr(b).isalnum())
_TABLE = bytes((b | 0x20 if 0x41 <= b <= 0x5A else b) if b in _KEEP else 0x20 for b in range(256))


def guarded(text: bytes) -> bytes:
    """The text as terms between boundary marks."""
    return b" " + text.translate(_TABLE) + b" "


class Shard:
    """Terms of some items and, per term, the items that hold it."""

    def __init__(self, rows: list[tuple]) -> None:
        """``rows``: distinct (item_id, term)."""
        self.items = sorted({i for i, _ in rows}, key=lambda i: (i is None, i))
        self.terms = sorted({t for _, t in rows})
        item, term = {x: k for k, x in enumerate(self.items)}, {x: k for k, x in enumerate(self.terms)}
        pairs = np.array(sorted((term[t], item[i]) for i, t in rows), np.int64).reshape(-1, 2)
        self.holders = pairs[:, 1]
        self.starts = np.searchsorted(pairs[:, 0], np.arange(len(self.terms) + 1))
        self._automaton = None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_automaton": None}

    def automaton(self):
        """Built once per worker."""
        if self._automaton is None:
            import ahocorasick

            self._automaton = ahocorasick.Automaton()
            for k, t in enumerate(self.terms):
                self._automaton.add_word(f" {t.decode('latin-1')} ", k)
            self._automaton.make_automaton()
        return self._automaton

    def counts(self, text: bytes) -> tuple[int, list[int], list[int]]:
        """Number of terms of a text; the items' terms in it, rising, with their frequencies."""
        marked = guarded(text)
        found = Counter(map(itemgetter(1), self.automaton().iter(marked.decode("latin-1"))))
        own = sorted(found)
        return len(marked.split()), own, [found[t] for t in own]

    def scores(self, n: np.ndarray, ends: np.ndarray, term: np.ndarray, tf: np.ndarray, weight: np.ndarray, docs: int, length: int) -> np.ndarray:
        """Score of every (document, item); a document's terms are ``term[ends[d]:ends[d + 1]]``."""
        out = np.zeros((len(n), len(self.items)), np.int64)
        doc = np.repeat(np.arange(len(n)), np.diff(ends))
        m = 50 + 50 * n * docs // length
        part = weight[term] * (1_000_000_000 * tf // (1000 * tf + 20 * m[doc]))
        fan = self.starts[term + 1] - self.starts[term]
        place = np.repeat(self.starts[term] - (np.cumsum(fan) - fan), fan) + np.arange(int(fan.sum()))
        np.add.at(out.ravel(), np.repeat(doc, fan) * len(self.items) + self.holders[place], np.repeat(part, fan))
        return out


class Best:
    """The ``k`` best documents of each item so far: highest score, then smallest id, no id last."""

    def __init__(self, items: int, k: int) -> None:
        self.k, self.floor = k, np.zeros(items, np.int64)
        self.held = tuple(np.empty(0, t) for t in (np.int64, np.int64, bool, np.int64))  # item, score, no id, id

    def add(self, scores: np.ndarray, no_id: np.ndarray, ids: np.ndarray) -> None:
        d, i = np.nonzero((scores > 0) & (scores >= self.floor))
        if not len(d):
            return
        item, score, lacks, own = (np.concatenate(x) for x in zip(self.held, (i, scores[d, i], no_id[d], ids[d]), strict=True))
        order = np.lexsort((own, lacks, -score, item))
        item, score, lacks, own = item[order], score[order], lacks[order], own[order]
        first = np.searchsorted(item, np.arange(len(self.floor)))
        rank = np.arange(len(item)) - first[item]
        full = item[rank == self.k - 1]
        self.floor[full] = score[rank == self.k - 1]
        self.held = tuple(x[rank < self.k] for x in (item, score, lacks, own))


def _item_terms(items: DataFrame, item_id: str, text: str) -> DataFrame:
    """Distinct (item_id, term) of all items."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            found = [(i, t) for i, x in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) if x for t in set(guarded(x).split())]
            yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in found], pa.int64()), pa.array([t for _, t in found], pa.binary())], ["item_id", "term"])

    return items.select(F.col(item_id).cast("long"), F.col(text).cast("binary")).mapInArrow(run, "item_id long, term binary").distinct()


def _shards(terms: DataFrame, limit: int) -> tuple[DataFrame, int]:
    """``terms`` with a column ``shard`` below the returned number; no shard is above the limits but by one item."""
    per = stored(terms.groupBy("item_id").agg(F.sum(F.length("term") + 2).alias("size")), "item-sizes")
    total = per.agg(F.sum("size"), F.count(F.lit(1))).first()
    shards = max(1, -(-(total[0] or 0) // limit), -(-total[1] // SHARD_ITEMS))
    while True:
        shard = F.pmod(F.xxhash64("item_id"), F.lit(shards)).cast("int")
        over = per.groupBy(shard).agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("n")).where((F.col("n") > 1) & ((F.col("size") > limit) | (F.col("n") > SHARD_ITEMS)))
        if shards == 1 and total[1] <= 1 or over.isEmpty():
            release(per)
            return terms.withColumn("shard", shard), shards
        shards *= 2


def _search_shard(docs: DataFrame, shard: Shard, k: int) -> DataFrame:
    sent = docs.sparkSession.sparkContext.broadcast(shard)

    def scan(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in (big.slice(a, 512) for big in batches for a in range(0, big.num_rows, 512)):
            found = [sent.value.counts(t) if t else (0, [], []) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([x[0] for x in found], pa.int64()), pa.array([x[1] for x in found], pa.list_(pa.int32())),
                                              pa.array([x[2] for x in found], pa.list_(pa.int64()))], ["doc_id", "n", "terms", "tf"])

    counted = stored(docs.mapInArrow(scan, "doc_id long, n long, terms array<int>, tf array<long>"), "term-counts")
    n_docs, length = counted.where("n > 0").agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    held = np.zeros(len(shard.terms), np.int64)
    for r in counted.select(F.explode("terms").alias("term")).groupBy("term").count().collect():  # at most the shard's terms
        held[r["term"]] = r["count"]
    weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(df) + 1))) for df in held], np.int64)

    def score(batches: Iterator) -> Iterator:
        import pyarrow as pa

        s, best = sent.value, Best(len(sent.value.items), k)
        for batch in (big.slice(a, 512) for big in batches for a in range(0, big.num_rows, 512)):
            ids = batch.column(0)
            ends = np.concatenate([[0], np.cumsum([len(x) for x in batch.column(2)])]).astype(np.int64)
            term, tf = (batch.column(c).flatten().to_numpy(zero_copy_only=False).astype(np.int64) for c in (2, 3))
            got = s.scores(batch.column(1).to_numpy(), ends, term, tf, weight, n_docs, max(1, length))
            best.add(got, ids.is_null().to_numpy(zero_copy_only=False), ids.fill_null(0).to_numpy())
        item, points, lacks, own = best.held
        yield pa.RecordBatch.from_arrays([pa.array([s.items[i] for i in item], pa.int64()), pa.array(own, pa.int64(), mask=lacks), pa.array(points, pa.int64())],
                                         ["item_id", "doc_id", "score"])

    return counted.where("n > 0").mapInArrow(score, "item_id long, doc_id long, score long")


def lexical_search(docs: DataFrame, items: DataFrame, k: int = 50, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
                   item_text: str = "text", automaton_bytes: int = AUTOMATON_BYTES) -> DataFrame:
    """The ``k`` documents of highest score above 0 for each item: item_id, rank (from 1), doc_id, score.

    With N documents that hold a term, L terms in all, n terms in a document, df documents holding a term
    and tf its occurrences there: w = floor(1000 ln((2N + 2) / (2 df + 1))), m = 50 + (50 n N) div L, and a
    document scores the sum of w * ((10^9 tf) div (1000 tf + 20 m)) over the item's distinct terms, in 64-bit
    integers. Equal scores rank by rising doc_id, a null one last.

    Null and empty texts hold no term: such documents score nothing, such items have no row. Rows that
    repeat a doc_id are documents of their own; rows that repeat an item_id are one item with the terms of
    all, and so are rows without one. Empty tables give no rows. Only the named columns are read; both ids
    must be integers.
    """
    terms = stored(_item_terms(items, item_id, item_text), "item-terms")
    dealt, shards = _shards(terms, automaton_bytes)
    texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("text"))
    found = []
    for s in range(shards):
        rows = [(r["item_id"], bytes(r["term"])) for r in dealt.where(F.col("shard") == s).select("item_id", "term").toLocalIterator()]  # bounded by _shards
        if rows:
            found.append(_search_shard(texts, Shard(rows), k))
    if not found:
        return docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    best = reduce(DataFrame.unionByName, found)
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    few = (best.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)))
           .withColumn("rank", F.row_number().over(Window.partitionBy("item_id", "salt").orderBy(*order))).where(F.col("rank") <= k))
    return (few.withColumn("rank", F.row_number().over(Window.partitionBy("item_id").orderBy(*order))).where(F.col("rank") <= k)
            .select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score"))
