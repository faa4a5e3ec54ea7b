"""Mixing sources to target weights by systematic sampling.

Every document of a source has the same expected number of copies, target / source size.
These expectations are summed up along the source's documents (ordered by size, so that the
words taken follow the target closely), one random offset per source is added, and a document
is emitted once for each integer boundary that its interval crosses. The offset is drawn from
a seeded digest of the source, so reruns agree.

Nothing is collected and no source meets in one task: ranks come from per-cell counts
(:func:`martforge.llm.common.ranked`). Only the table of sources (one row each) is summed in one
window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martforge.llm.common import ranked

WEIGHTS = (5, 2, 1)


def unit_offset(seed: str, *parts: Column) -> Column:
    """A number in [0, 1) drawn from a digest of the seed and the parts."""
    head = F.substring(F.md5(F.concat(F.lit(seed + "|"), *parts)), 1, 8)
    return F.conv(head, 16, 10).cast("long") / F.lit(float(2**32))


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, most: float = 2.0) -> DataFrame:
    """Targets of sources.

    ``sizes``: (no_source boolean, src string, source_size long), one row a source. Sources in
    code-point order, the null source last, get ``weights`` in turn and share ``share`` times all
    sizes; a target stops at ``most`` times its source's size and the excess is shared anew by
    weight. That is one level L with target = min(most * size, L * weight): sources are taken by
    rising most * size / weight until the first that L does not fill.
    """
    by_name = Window.orderBy("no_source", "src")
    by_fill = Window.orderBy("_fill", "_no")
    all_rows = Window.partitionBy()
    cycle = F.array(*[F.lit(w) for w in weights])
    s = (sizes.withColumn("_no", F.row_number().over(by_name))
         .withColumn("_w", F.element_at(cycle, (F.pmod(F.col("_no") - 1, F.lit(len(weights))) + 1).cast("int")))
         .withColumn("_cap", F.col("source_size") * F.lit(most))
         .withColumn("_fill", F.col("_cap") / F.col("_w"))
         .withColumn("_total", F.sum("source_size").over(all_rows) * F.lit(share))
         .withColumn("_filled", F.coalesce(F.sum("_cap").over(by_fill.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
         .withColumn("_open", F.sum("_w").over(by_fill.rowsBetween(Window.currentRow, Window.unboundedFollowing)))
         .withColumn("_level", (F.col("_total") - F.col("_filled")) / F.col("_open"))
         .withColumn("_k", F.row_number().over(by_fill)))
    first = F.when(F.col("_fill") >= F.col("_level"), F.struct("_k", "_level"))
    s = s.withColumn("_stop", F.min(first).over(all_rows))
    return s.select(
        "no_source", "src", "source_size",
        F.when(F.col("_k") < F.col("_stop._k"), F.col("_cap"))
        .otherwise(F.least(F.col("_cap"), F.col("_stop._level") * F.col("_w"))).alias("target"))


def mix_sources(docs: DataFrame, size: Column, source: Column, doc_id: Column, keep: Column | None = None,
                weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, most: float = 2.0, seed: str = "mix-1") -> DataFrame:
    """Copies of each document in the mix.

    Returns one row per row of ``docs``: doc_id, size, source_size, target, copies, taken (copies
    times size) and, if ``keep`` is given, that expression as ``kept_row``. A null source is a
    source of its own; a null doc_id counts as empty text in the order; repeated rows count one by
    one; texts without words have size 0 and take nothing; an empty table gives no rows. Only the
    given expressions are read, so other columns of ``docs`` cannot clash.
    """
    extra = [] if keep is None else [keep.alias("kept_row")]
    d = docs.select(doc_id.alias("doc_id"), size.cast("long").alias("size"), source.isNull().alias("no_source"),
                    F.coalesce(source.cast("string"), F.lit("")).alias("src"), *extra)
    # Cells in rising size: bit length, then the leading four bits, then a digest of the id.
    d = (d.withColumn("_bits", F.length(F.bin("size")))
         .withColumn("_lead", F.expr("shiftright(size, greatest(_bits - 4, 0))"))
         .withColumn("_part", F.substring(F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 1, 2)))
    targets = source_targets(d.groupBy("no_source", "src").agg(F.sum("size").alias("source_size")), weights, share, most)
    d = ranked(d, ["no_source", "src"], ["_bits", "_lead", "_part"], ["size", "doc_id"], "_rank")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    offset = unit_offset(seed, F.col("no_source").cast("string"), F.lit("|"), F.col("src"))
    # least: rounding may carry a rate of exactly `most` over one more boundary.
    copies = F.least(F.floor(F.col("_r") * (F.col("_rank") + 1) + F.col("_u")) - F.floor(F.col("_r") * F.col("_rank") + F.col("_u")),
                     F.ceil("_r"))
    d = (d.join(targets, ["no_source", "src"]).withColumn("_r", rate).withColumn("_u", offset)
         .withColumn("copies", copies.cast("long")))
    return d.select("doc_id", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"),
                    *(["kept_row"] if extra else []))


def emit(docs: DataFrame, copies_of: DataFrame) -> DataFrame:
    """Rows of ``docs`` from a mix whose ``kept_row`` packs them, each repeated ``copies`` times."""
    return (copies_of.where("copies > 0")
            .withColumn("_no", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
            .select(*[F.col("kept_row").getField(c).alias(c) for c in docs.columns]))
