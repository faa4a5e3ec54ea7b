"""Quality rules with cross-document line frequency, in DataFrame functions only.

Per text: words, code points in words, symbols, repeated lines and words inside repeated three-word
windows. Across texts: lines are normalised (lower case, digits as 0, runs of other characters than
letters and digits as one blank) and hashed; for each host the distinct documents of every line are
counted; lines that at least ``least_docs`` documents and more than ``max_share`` percent of the host's
documents share are taken out; a document of which too little remains is rejected.

The hashes of all lines are written once. Distinct (document, line) pairs spread by document, and
their counts are summed up on the map side, so a line that all documents share moves one row per
task. Line and document rows carry hashes and counts, never texts. The join of lines with the frequent ones is a plain equi-join that adaptive execution
splits where a key is hot; nothing is broadcast by force and nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martforge.llm.common import small_side, stored, word_count

SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[^#*$%&|<>]+"
#: Up to so many different repeated windows, members are found by a scan of their list, else by sorting.
_FEW = 16


def words_of(text: Column) -> Column:
    """Array of words; empty for null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE, -1), lambda w: w != "")


def with_repeat_words(df: DataFrame, words: str, name: str) -> DataFrame:
    """Replace the array column ``words`` by ``name``: words inside three-word windows that occur twice or more.

    Windows are hashed and sorted; equal neighbours are the repeated ones. Every intermediate array
    is a column of its own, so no lambda computes one again for each element.
    """
    df = df.withColumn("_h", F.transform(words, lambda x: F.xxhash64(x))).drop(words)
    df = df.withColumn("_win", F.transform(F.slice("_h", F.lit(1), F.greatest(F.size("_h") - 2, F.lit(0))),
                                           lambda h, i: F.xxhash64(h, F.get("_h", i + 1), F.get("_h", i + 2)))).drop("_h")
    df = df.withColumn("_sorted", F.sort_array("_win"))
    df = df.withColumn("_twice", F.array_distinct(F.filter("_sorted", lambda x, i: (i > 0) & (x == F.get("_sorted", i - 1))))).drop("_sorted")
    many = F.size("_twice") > _FEW
    df = df.withColumn("_pairs", F.when(many, F.sort_array(F.transform("_win", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    same = F.filter("_pairs", lambda x, j: F.coalesce(x["h"] == F.get("_pairs", j - 1)["h"], F.lit(False))
                    | F.coalesce(x["h"] == F.get("_pairs", j + 1)["h"], F.lit(False)))
    few = F.filter(F.transform("_win", lambda h, i: F.when(F.array_contains("_twice", h), i)), lambda i: i.isNotNull())
    df = df.withColumn("_at", F.when(many, F.sort_array(F.transform(same, lambda x: x["i"])))
                       .when(F.size("_twice") > 0, few).otherwise(F.array().cast("array<int>"))).drop("_pairs", "_win", "_twice")
    # A window covers three words, less what the next one covers as well.
    cover = F.transform("_at", lambda p, j: F.least(F.lit(3), F.coalesce(F.get("_at", j + 1) - p, F.lit(3))))
    return df.withColumn(name, F.aggregate(cover, F.lit(0), lambda a, x: a + x).cast("long")).drop("_at")


def normal_line(line: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(line), r"\p{Nd}", "0"), r"[^\p{L}0]+", " "))


def line_quality(docs: DataFrame, doc_id: Column, text: Column, host: Column, min_words: int = 50, max_repeat: int = 50,
                 least_docs: int = 5, max_share: int = 5, min_left: int = 30) -> DataFrame:
    """Metrics and verdict per document.

    Returns doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    n_removed_words (words on lines above both limits) and kept. base_failed: fewer than ``min_words``
    words, or more than ``max_repeat`` percent of the words in repeated windows. kept: not
    base_failed, and after removal at least ``min_left`` percent of the words remain.

    Null text: no words, so base_failed. A null host is a host of its own. Lines without letter or
    digit are never counted. Rows with equal doc_id and text are one document for the line counts,
    and each of them gets a row; an empty table gives none. Only the given expressions are read.
    """
    rows = docs.select(doc_id.alias("doc_id"), text.alias("text"), host.isNull().alias("no_host"),
                       F.coalesce(host.cast("string"), F.lit("")).alias("host"))
    rows = rows.withColumn("key", F.xxhash64(F.col("doc_id"), F.coalesce(F.col("text"), F.lit("")), F.col("text").isNull()))

    measured = (rows.withColumn("w", words_of(F.col("text")))
                .withColumn("lines", F.filter(F.split(F.coalesce("text", F.lit("")), "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
                .select("doc_id", "key", "w", F.size("w").cast("long").alias("n_words"),
                        F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
                        F.length(F.regexp_replace(F.coalesce("text", F.lit("")), SYMBOLS, "")).cast("long").alias("n_symbols"),
                        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines")))
    measured = with_repeat_words(measured, "w", "n_repeat_words")

    lines = (rows.select("key", "no_host", "host", F.split(F.coalesce("text", F.lit("")), "\n", -1).alias("lines"))
             .select("key", "no_host", "host", F.posexplode("lines").alias("pos", "line"))
             .select("key", "no_host", "host", "pos", normal_line(F.col("line")).alias("norm"), word_count(F.col("line")).alias("n"))
             .where("norm != ''").withColumn("hash", F.xxhash64("norm")).drop("norm"))
    lines = stored(lines, "line-hashes")
    counted = (lines.groupBy("key", "no_host", "host", "hash").agg(F.lit(1).alias("one"))
               .groupBy("no_host", "host", "hash").agg(F.count(F.lit(1)).alias("n_docs")).where(F.col("n_docs") >= least_docs))
    # Documents per host, lines or not: one row per host.
    hosts = stored(rows.groupBy("no_host", "host", "key").agg(F.lit(1).alias("one")).groupBy("no_host", "host").agg(F.count(F.lit(1)).alias("host_docs")), "hosts")
    counted = counted.join(small_side(hosts, 64), ["no_host", "host"]).where(F.col("n_docs") * 100 > F.col("host_docs") * max_share).drop("host_docs")
    # Equal rows share a key: each of their places counts once.
    removed = (lines.join(counted, ["no_host", "host", "hash"])
               .groupBy("key", "pos").agg(F.max("n").alias("n"))
               .groupBy("key").agg(F.sum("n").alias("n_removed_words")))
    out = measured.join(removed, "key", "left").withColumn("n_removed_words", F.coalesce("n_removed_words", F.lit(0).cast("long")))
    failed = (F.col("n_words") < min_words) | (F.col("n_repeat_words") * 100 > F.col("n_words") * max_repeat)
    left = (F.col("n_words") - F.col("n_removed_words")) * 100 >= F.col("n_words") * min_left
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      failed.alias("base_failed"), "n_removed_words", (~failed & left).alias("kept"))
