"""Spelling variants: words one edit apart, found with a bit-sliced position index.

Vocabulary. Runs of letters of whole texts are counted per task in bounded tables and summed up by word.

Routing. Two words one edit apart share, cut at half the length L of the shorter, their first half or
their last half. A word of length n takes part as one of length L = n and as the longer one of
L = n - 1, under both halves: four buckets, none of which loses a pair. Buckets above ``block`` words
are cut into blocks that meet pairwise in separate groups.

Index. The words of a group stand in lanes of 64; many small groups are searched together. For a position, the index holds one 64-bit set per
(letter, lane): the words with that letter there. For a queried word with letters q the sets of all
lanes advance together, one position at a time::

    exact    E' = E & at[i][q_i]                               no error so far
    replaced R' = (R & at[i][q_i]) | (E & ~at[i][q_i])         one letter replaced
    longer   I' = (I | E) & at[i + 1][q_i]                     the word has one letter more, before q_i

so zero-error and one-error sets are tracked at the same time, by word-parallel operations on
shifted positions. A letter missing from the word is the third case seen from the other side: pairs of
different length are queried from the shorter word and count for both. Only the sets of two
positions exist at any time, so the index does not grow with the length of words.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martforge.llm.common import stored


TALLY_WORDS = 200_000  # words that a task counts before it passes them on
BLOCK_WORDS = 8192  # words of a bucket that meet others in one group
CHUNK_ROWS = 32_768  # rows whose small groups are searched together

_ONE = np.uint64(1)


def tally(docs: DataFrame, spoil: Callable[[str, str], str] | None = None, doc_id: str = "doc_id", text: str = "text", shortest: int = 7,
          hold: int = TALLY_WORDS) -> DataFrame:
    """word, n: occurrences of the lower-cased (A-Z only) letter runs of whole texts.

    ``spoil`` (document id as text, run) -> word is applied before words shorter than ``shortest`` go. A task
    holds about ``hold`` words before it passes them on.
    """
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        def rows(c: Counter):
            return pa.RecordBatch.from_arrays([pa.array(list(c), pa.string()), pa.array(list(c.values()), pa.int64())], ["word", "n"])

        total: Counter = Counter()
        long_run = re.compile(f"[a-zÀ-ÿ]{{{shortest},}}")  # a change never makes a run longer
        for batch in batches:
            for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if not t:
                    continue
                own = Counter(long_run.findall(t.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")))
                own = own.items() if spoil is None else ((spoil("" if i is None else str(i), w), n) for w, n in own.items())
                for w, n in own:
                    if len(w) >= shortest:
                        total[w] += n
                if len(total) >= hold:
                    yield rows(total)
                    total.clear()
        if total:
            yield rows(total)

    counted = docs.select(F.col(doc_id).cast("string"), F.col(text).cast("string")).mapInArrow(run, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


def crc_deletion(doc_id: str, run: str, every: int = 31) -> str:
    """The run less one letter where ``every`` divides the crc32 of ``<doc_id>:<run>``."""
    h = zlib.crc32(f"{doc_id}:{run}".encode())
    if h % every:
        return run
    k = h % len(run)
    return run[:k] + run[k + 1:]


def _letters(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Letters one after the other (a zero after each word), the start and the size of each word."""
    flat = np.frombuffer(b"\x00".join(words) + b"\x00\x00", np.uint8)
    size = np.fromiter(map(len, words), np.int64, len(words))
    return flat, np.concatenate([[0], np.cumsum(size + 1)[:-1]]), size


class SlicedIndex:
    """Bit-sliced position index of words in units; a word is only looked for among the words of one unit."""

    def __init__(self, words: list[bytes], unit: np.ndarray) -> None:
        self.flat, self.start, self.size = _letters(words)
        order = np.argsort(unit, kind="stable")
        count = np.bincount(unit)
        place = np.empty(len(words), np.int64)
        place[order] = np.arange(len(words)) - np.repeat(np.cumsum(count) - count, count)
        self.n_lanes = (count + 63) >> 6
        self.first_lane = np.cumsum(self.n_lanes) - self.n_lanes
        self.lanes = int(self.n_lanes.sum())
        self.lane, bit = self.first_lane[unit] + (place >> 6), place & 63
        self.bit = _ONE << bit.astype(np.uint64)
        self.word_at = np.full(self.lanes * 64, -1, np.int64)
        self.word_at[self.lane * 64 + bit] = np.arange(len(words))
        # Letters in use get small numbers; 0 stands for none.
        used = np.unique(self.flat)
        used = used[used > 0]
        self.number = np.zeros(256, np.int64)
        self.number[used] = np.arange(1, len(used) + 1)
        self.letters = len(used) + 1

    def _sets(self, cell: np.ndarray, bits: np.ndarray, n: int) -> np.ndarray:
        out = np.zeros(n, np.uint64)
        if len(cell):
            order = np.argsort(cell, kind="stable")
            cell, bits = cell[order], bits[order]
            first = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]]))
            out[cell[first]] = np.bitwise_or.reduceat(bits, first)
        return out

    def at(self, i: int) -> np.ndarray:
        """Sets of the words with each letter at position i: letters x lanes, flat."""
        has = np.flatnonzero(self.size > i)
        letter = self.number[self.flat[self.start[has] + i]]
        return self._sets(letter * self.lanes + self.lane[has], self.bit[has], self.letters * self.lanes)

    def of_size(self, n: int) -> np.ndarray:
        own = np.flatnonzero(self.size == n)
        return self._sets(self.lane[own], self.bit[own], self.lanes)

    def near(self, asked: np.ndarray, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (i, j) of words: ``asked`` ones i, all of one length, and words j of the unit looked in that
        come out of i by replacing one letter or by inserting one."""
        per = self.n_lanes[unit]
        who = np.repeat(asked, per)
        lane = np.repeat(self.first_lane[unit] - (np.cumsum(per) - per), per) + np.arange(len(who))
        length, letters = int(self.size[asked[0]]), self.start[who]
        same, longer = self.of_size(length)[lane], self.of_size(length + 1)[lane]
        exact, replaced, inserted = same | longer, np.zeros(len(who), np.uint64), np.zeros(len(who), np.uint64)
        here = self.at(0)
        for i in range(length):
            after = self.at(i + 1)
            place = self.number[self.flat[letters + i]] * self.lanes + lane
            hit = here[place]
            inserted = (inserted | exact) & after[place]
            replaced = (replaced & hit) | (exact & ~hit)
            exact = exact & hit
            here = after
        found = (replaced & same) | ((inserted | exact) & longer)  # a letter more at the end: equal so far
        some = np.flatnonzero(found)
        bits = np.unpackbits(found[some].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        x, y = np.nonzero(bits)
        return who[some[x]], self.word_at[lane[some[x]] * 64 + y]


def _found(length: int, side: int, group: np.ndarray, apart: np.ndarray, second: np.ndarray, text: list[str], n: np.ndarray):
    """Per word: number of near words found here and the best of them, for groups of one length and side.

    In groups of two blocks (``apart``) words are looked for among those of the other block only.
    """
    import pyarrow as pa

    words = [x.encode("latin-1") for x in text]
    index = SlicedIndex(words, 2 * group + second)
    asked = np.flatnonzero(index.size == length)
    if not len(asked):
        return None
    x, y = index.near(asked, 2 * group[asked] + np.where(apart[asked], 1 - second[asked], 0))
    if side:  # pairs with a common first half are found there
        h = length // 2
        fresh = np.fromiter((words[p][:h] != words[q][:h] for p, q in zip(x.tolist(), y.tolist(), strict=True)), bool, len(x))
        x, y = x[fresh], y[fresh]
    if not len(x):
        return None
    grown = index.size[y] > length  # asked from the shorter word only
    a, b = np.concatenate([x, y[grown]]), np.concatenate([y, x[grown]])
    name = np.empty(len(words), np.int64)
    name[sorted(range(len(words)), key=words.__getitem__)] = np.arange(len(words))  # Latin-1 bytes rise as code points do
    order = np.lexsort((name[b], -n[b], a))
    a, b = a[order], b[order]
    first = np.flatnonzero(np.concatenate([[True], a[1:] != a[:-1]]))
    count = np.diff(np.concatenate([first, [len(a)]]))
    return pa.RecordBatch.from_arrays(
        [pa.array([text[k] for k in a[first]], pa.string()), pa.array(count, pa.int64()),
         pa.array(n[b[first]], pa.int64()), pa.array([text[k] for k in b[first]], pa.string())], ["word", "n_near", "best_n", "best_word"])


def _whole_groups(batches: Iterator, keys: list[str]) -> Iterator[tuple]:
    """Tables of about CHUNK_ROWS rows that cut no group of equal ``keys``, with the number of each row's group."""
    import pyarrow as pa
    import pyarrow.compute as pc

    def numbers(t) -> np.ndarray:
        change = np.zeros(t.num_rows - 1, bool)
        for k in keys:
            c = t.column(k).combine_chunks()
            change |= pc.not_equal(c.slice(1), c.slice(0, len(c) - 1)).to_numpy(zero_copy_only=False)
        return np.concatenate([[0], np.cumsum(change)])

    held, rows = [], 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows < CHUNK_ROWS:
            continue
        t = pa.Table.from_batches(held)
        group = numbers(t)
        cut = int(np.searchsorted(group, group[-1]))  # the last group may go on
        if cut:
            yield t.slice(0, cut), group[:cut]
        held, rows = t.slice(cut).to_batches(), t.num_rows - cut
    if rows:
        t = pa.Table.from_batches(held)
        yield t, numbers(t)


def neighbours(words: DataFrame, block: int = BLOCK_WORDS) -> DataFrame:
    """word, n_near, best (n, word): number of words one edit away, and the one of largest n (ties: smallest).

    ``words``: word (Latin-1 letters), n; distinct words. Words without a near word have no row.
    """
    size, half, bucket = F.length("word").cast("int"), F.floor(F.col("len") / 2).cast("int"), ["len", "side", "half"]
    keyed = (words.withColumn("len", F.explode(F.array(size, size - 1))).where("len >= 0")
             .withColumn("side", F.explode(F.array(F.lit(0), F.lit(1))))
             .withColumn("half", F.when(F.col("side") == 0, F.substring("word", F.lit(1), half))
                         .otherwise(F.substring("word", size - (F.col("len") - half) + 1, F.col("len") - half))))
    cuts = (keyed.groupBy(*bucket).agg(F.count(F.lit(1)).alias("c"), F.max((size == F.col("len")).cast("int")).alias("asks"))
            .where("c > 1 and asks = 1").select(*bucket, F.ceil(F.col("c") / block).cast("int").alias("blocks")))
    placed = keyed.join(cuts, bucket).withColumn("block", F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int"))
    place = [*bucket, "i", "j"]
    met = (placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
           .select(*bucket, F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
                   (F.col("block") > F.col("other")).cast("int").alias("second"), "word", "n")
           .repartition(*place).sortWithinPartitions(*place))

    def look(batches: Iterator) -> Iterator:
        for t, group in _whole_groups(batches, place):
            col = {k: t.column(k).to_numpy() for k in ("len", "side", "i", "j", "second", "n")}
            kind = np.concatenate([[0], np.flatnonzero((np.diff(col["len"]) != 0) | (np.diff(col["side"]) != 0)) + 1, [t.num_rows]]).tolist()
            for lo, hi in zip(kind[:-1], kind[1:], strict=True):
                own = slice(lo, hi)
                out = _found(int(col["len"][lo]), int(col["side"][lo]), group[own] - group[lo], (col["i"] != col["j"])[own],
                             col["second"][own].astype(np.int64), t.column("word").slice(lo, hi - lo).to_pylist(), col["n"][own])
                if out is not None:
                    yield out

    found = met.mapInArrow(look, "word string, n_near long, best_n long, best_word string")
    best = F.min(F.struct((-F.col("best_n")).alias("m"), F.col("best_word").alias("w"))).alias("b")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best).select(
        "word", "n_near", F.struct((-F.col("b.m")).alias("n"), F.col("b.w").alias("word")).alias("best"))


def follow(links: DataFrame) -> DataFrame:
    """word, root: the last word reached from ``word`` along ``links`` (word, form), which have no cycle.

    Steps double each round; a form's n is a multiple of its word's, so chains are short.
    """
    reach = stored(links.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        ahead = reach.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = reach.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        step = stored(step, "spelling-roots")
        reach = step.select("word", "root")
        if step.where("moved").isEmpty():
            return reach


def spelling_groups(words: DataFrame, factor: int = 10, block: int = BLOCK_WORDS) -> DataFrame:
    """Groups of spelling variants of a vocabulary.

    ``words``: word, n with letters from U+0001 to U+00FF. Two words are near if they differ by exactly one
    inserted, deleted or replaced code point. A word's form is its near word of largest n (ties: the
    smallest word), if that n >= ``factor`` * the word's n, else null; its root is the last word reached
    along forms. Returns one row per word: word, form, root, n, n_near (0 if none), form_n.

    Null words and words with other characters are left out of the search and have no near word; rows that
    repeat a word are summed up (a null n counts as 0); the empty word is near to words of one letter. An
    empty table gives no rows. Extra columns are not read. ``block`` bounds the words of a task's group.
    """
    if factor < 2:
        raise ValueError("factor must be 2 or more, or forms could run in a circle")
    own = stored(words.select("word", F.coalesce("n", F.lit(0)).cast("long").alias("n")).groupBy("word").agg(F.sum("n").alias("n")), "spelling-words")
    found = neighbours(own.where(F.col("word").rlike("^[\\x01-ÿ]*$")), block)
    told = own.join(found, "word", "left").withColumn("best", F.when((F.col("best.n") >= factor * F.col("n")) & (F.col("best.n") > F.col("n")), F.col("best")))
    told = stored(told.select("word", F.col("best.word").alias("form"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
                              F.col("best.n").alias("form_n")), "spelling-forms")
    roots = follow(told.where("form is not null").select("word", "form"))
    return told.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def variant_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shortest: int = 7, least: int = 2, factor: int = 10,
                   spoil: Callable[[str, str], str] | None = crc_deletion) -> DataFrame:
    """Spelling groups of the words of whole texts: those of ``shortest`` letters and ``least`` occurrences.

    A null text has no words; a null doc_id is the empty text to ``spoil``; rows that repeat a doc_id
    count each. See :func:`spelling_groups` for the result.
    """
    return spelling_groups(tally(docs, spoil, doc_id, text, shortest).where(F.col("n") >= least), factor)
