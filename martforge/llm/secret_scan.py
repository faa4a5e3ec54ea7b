"""Secret scans with corpus-wide ownership, in DataFrame functions only.

Candidates are found per text by patterns. The hash of every candidate value is counted over the
whole corpus by distinct repositories and distinct owners: a value that many owners hold is a copied
example; one that stays with few owners looks like a live credential. Besides the base kinds
(assignments, access keys, hex strings) there is a kind of long mixed tokens that no base pattern
reports; such a token becomes a span only if its ownership looks live.

Spans come from the regular-expression engine itself: the pieces between matches and the matches are
cut out in order, and their lengths summed up give code-point positions. Only hashes, ids and
positions are shuffled. Distinct (value, owner) pairs are reduced on the map side before they are
counted, so a value that all rows hold moves one row per task and owner.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martforge.llm.common import stored

#: Fixed patterns; a match of a kind counts from the given length (of the value) on.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
#: [0-9a-f]+ takes maximal runs; the look-behind finds those of 24 and more, each run tried once.
HEX = r"(?<![0-9a-f])[0-9a-f]{24,}"
MIXED = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{24,}"
KINDS = ("assign", "access", "hex", "mixed")

_SPAN = "array<struct<start:int,kind:int,end:int,value:bigint>>"


def spans(text: Column, pattern: str, kind: int, value_group: int, counts: Callable[[Column], Column]) -> Column:
    """Matches whose value ``counts``, as array of (start, kind, end, hash of the value).

    Texts without a match are told apart by one search and cost no more than that.
    """
    found, values = F.regexp_extract_all(text, F.lit(pattern), 0), F.regexp_extract_all(text, F.lit(pattern), value_group)
    between = F.transform(F.split(text, pattern, -1), lambda s: F.length(s))
    both = F.transform(F.arrays_zip(between.alias("gap"), found.alias("hit"), values.alias("value")),
                       lambda x: F.struct(x["gap"].alias("gap"), F.length(x["hit"]).alias("size"), x["value"].alias("value")))
    empty = F.struct(F.lit(0).alias("at"), F.array().cast(_SPAN).alias("out"))
    walked = F.aggregate(
        both, empty,
        lambda a, x: F.struct(
            (a["at"] + x["gap"] + F.coalesce(x["size"], F.lit(0))).alias("at"),
            F.when(counts(x["value"]),
                   F.concat(a["out"], F.array(F.struct((a["at"] + x["gap"]).alias("start"), F.lit(kind).alias("kind"),
                                                       (a["at"] + x["gap"] + x["size"]).alias("end"), F.xxhash64(x["value"]).alias("value")))))
            .otherwise(a["out"]).cast(_SPAN).alias("out")),
        lambda a: a["out"])
    return F.when(text.rlike(pattern), walked).otherwise(F.array().cast(_SPAN))


def long(n: int) -> Callable[[Column], Column]:
    return lambda value: F.length(value) >= n


def of_all_classes(value: Column) -> Column:
    return value.rlike("[a-z]") & value.rlike("[A-Z]") & value.rlike("[0-9]")


def find_candidates(docs: DataFrame, doc_id: Column, text: Column, repository: Column, owner: Column) -> DataFrame:
    """Base and mixed candidates of every row, written to the shared folder.

    Columns: key (of doc_id and text), doc_id, repository, no_owner, owner, base and mixed (arrays of
    (start, kind, end, value hash)). Mixed tokens that overlap a base span are left out.
    """
    t = F.coalesce(text, F.lit(""))
    found = docs.select(
        row_key(doc_id, text).alias("key"), doc_id.alias("doc_id"), F.coalesce(repository.cast("string"), F.lit("")).alias("repository"),
        owner.isNull().alias("no_owner"), F.coalesce(owner.cast("string"), F.lit("")).alias("owner"),
        F.array_sort(F.concat(spans(t, ASSIGN, 0, 2, long(6)), spans(t, ACCESS, 1, 0, long(20)), spans(t, HEX, 2, 0, long(24)))).alias("base"),
        spans(t, MIXED, 3, 0, of_all_classes).alias("mixed"))
    clear = F.filter("mixed", lambda m: ~F.exists("base", lambda b: (b["start"] < m["end"]) & (m["start"] < b["end"])))
    return stored(found.withColumn("mixed", clear), "secret-candidates")


def row_key(doc_id: Column, text: Column) -> Column:
    return F.xxhash64(doc_id, F.coalesce(text, F.lit("")))


def live_values(found: DataFrame, max_owners: int = 2, max_repositories: int | None = 20) -> DataFrame:
    """Ownership verdict: key, live (set of value hashes that look like live credentials).

    The distinct repositories and owners of each value are counted over the whole corpus, in steps
    that sum up on the map side: (value, owner, repository), then (value, owner), then value.
    Without ``max_repositories``, a value has as many independent holders as owners, but no more than
    repositories: many repositories of one owner, or one that several owners copied, are one holder.
    """
    each = found.select("key", "repository", "no_owner", "owner", F.explode(F.concat("base", "mixed")).alias("c")).withColumn("value", F.col("c.value"))
    owned = (each.groupBy("value", "no_owner", "owner", "repository").agg(F.lit(1).alias("one"))
             .groupBy("value", "no_owner", "owner").agg(F.count(F.lit(1)).alias("n"))
             .groupBy("value").agg(F.count(F.lit(1)).alias("owners"), F.sum("n").alias("repositories")))
    if max_repositories is None:
        held = each.groupBy("value", "repository").agg(F.lit(1).alias("one")).groupBy("value").agg(F.count(F.lit(1)).alias("distinct_repositories"))
        live = owned.join(held, "value").where(F.least("owners", "distinct_repositories") <= max_owners).select("value")
    else:
        live = owned.where((F.col("owners") <= max_owners) & (F.col("repositories") <= max_repositories)).select("value")
    return each.select("key", "value").join(live, "value").groupBy("key").agg(F.collect_set("value").alias("live"))


def scan_secrets(docs: DataFrame, doc_id: Column, text: Column, repository: Column, owner: Column,
                 max_owners: int = 2, max_repositories: int | None = 20) -> DataFrame:
    """Spans of every document with their ownership verdict.

    Returns one row per row of ``docs``: key, doc_id, base and spans, arrays of (start, kind, end,
    live) by start and kind; code points, end exclusive; kind is an index into KINDS. spans holds base
    and the mixed tokens that look live. A value looks live if at most ``max_owners`` owners and
    ``max_repositories`` repositories in the whole corpus hold it; others are widely copied examples.
    With None for ``max_repositories`` it looks live if at most ``max_owners`` owners, or at most so many
    distinct repositories (digests of texts, say), hold it, however many repositories an owner has.

    A null text is empty; a null owner or repository is one of its own (a null repository equals an
    empty one). Repeated rows count once for their owner and repository and each of them gets a row.
    An empty table gives no rows. Only the given expressions are read.
    """
    found = find_candidates(docs, doc_id, text, repository, owner)
    j = found.join(live_values(found, max_owners, max_repositories), "key", "left")

    def told(spans: str) -> Column:
        return F.transform(spans, lambda x: F.struct(x["start"].alias("start"), x["kind"].alias("kind"), x["end"].alias("end"),
                                                     F.coalesce(F.array_contains("live", x["value"]), F.lit(False)).alias("live")))

    j = j.select("key", "doc_id", told("base").alias("base"), F.filter(told("mixed"), lambda x: x["live"]).alias("more"))
    return j.select("key", "doc_id", "base", F.array_sort(F.concat("base", "more")).alias("spans"))


def count_kind(found: str, kind: int) -> Column:
    return F.size(F.filter(found, lambda x: x["kind"] == kind)).cast("long")


def spell(found: Column | str) -> Column:
    """Spans as kind:start:end, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(found, lambda x: F.concat_ws(":", F.get(names, x["kind"]), x["start"].cast("string"), x["end"].cast("string"))), ",")


def cut_text(text: Column, spans: str, put: str) -> Column:
    """``text`` with ``put`` in place of each of the ``spans`` (by start; overlapping ones count as one)."""
    begin = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    return F.aggregate(
        spans, begin,
        lambda a, x: F.struct(F.greatest(a["at"], x["end"]).alias("at"),
                              F.when(x["start"] >= a["at"], F.concat(a["out"], F.substring(text, a["at"] + 1, x["start"] - a["at"]), F.lit(put)))
                              .otherwise(a["out"]).alias("out")),
        lambda a: F.concat(a["out"], F.substring(text, a["at"] + 1, F.length(text))))


def redact(docs: DataFrame, doc_id: str, text: str, found: DataFrame, put: str = "[SECRET]") -> DataFrame:
    """``docs`` with every live span of ``found`` (from :func:`scan_secrets`) replaced by ``put``.

    Overlapping spans are replaced as one. Rows without live spans come back as they are; no row goes.
    """
    marks = (found.select("key", F.filter("spans", lambda x: x["live"]).alias("_cut")).where(F.size("_cut") > 0)
             .groupBy("key").agg(F.first("_cut").alias("_cut")))
    packed = docs.select(F.struct(*docs.columns).alias("_row"), row_key(F.col(doc_id), F.col(text)).alias("key"), F.col(text).alias("_text"))
    t = F.col("_text")
    out = packed.join(marks, "key", "left").withColumn("_text", F.when(F.col("_cut").isNull(), t).otherwise(cut_text(t, "_cut", put)))
    return out.select(*[F.col("_text").alias(c) if c == text else F.col("_row").getField(c).alias(c) for c in docs.columns])
