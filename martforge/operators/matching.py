"""Cumulative-quantity matching of scheduled lines to receipts.

For each group (e.g. a purchase-order item) the schedule lines, ordered by due date, need
``cum_sched`` units in total; the receipts, ordered by posting date, deliver ``cum_gr``. A
schedule line is completed by the first receipt (in receipt order) whose running total
reaches its running requirement: ``min(gr_rank) where cum_gr >= cum_sched``.

The textbook form is a non-equi left join on ``cum_gr >= cum_sched`` followed by a top-1
window - quadratic in the lines per group. Here lines and receipts are stacked and scanned twice:
in date order for ranks and running totals, then in falling cumulative quantity (receipts before
schedule lines on ties), where the receipt of smallest rank so far is, at a schedule line, the
earliest among all with at least its cumulative quantity.

By default both scans run in ranges with carries (:mod:`martforge.operators.rangescan`): four exchanges of
the stacked rows in all, and an item that holds most of the lines lies in many partitions. Callers whose
groups are mostly small let small ones be matched within one task, by windows after a single exchange
(``whole``): the rows are counted per bucket of the key's hash first, and only rows of buckets above that
size go through the ranges. The count is exact, so the two ways never share or miss a group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martforge.operators.rangescan import earliest_offer, running_sums

#: Buckets of the key's hash whose rows are counted: the list of the large ones is never longer.
BUCKETS = 1 << 16


def running_total(df: DataFrame, keys: Sequence[str], order: Sequence[Column], qty: str, out: str, rank: str | None = None) -> DataFrame:
    """Add ``out`` = running sum of ``qty`` and optionally ``rank`` = row number within ``keys``.

    ``order`` must be total per group. A group of any size is spread over the partitions.
    """
    return running_sums(df, keys, order, {out: F.col(qty)}, rank)


def completion_match(sched: DataFrame, receipts: DataFrame, keys: Sequence[str],
                     sched_order: Sequence[Column], sched_qty: str,
                     receipt_order: Sequence[Column], receipt_qty: str,
                     receipt_cols: Sequence[str],
                     sched_rank: str = "sched_rank", cum_sched: str = "cum_sched_qty",
                     gr_rank: str = "gr_rank", cum_gr: str = "cum_gr_qty", whole: int = 0) -> DataFrame:
    """Schedule lines (all columns + ``sched_rank``, ``cum_sched``) with the completing receipt's
    ``gr_rank``, ``cum_gr`` and ``receipt_cols`` (NULL when not yet completed).

    A NULL running requirement never completes; receipts with a NULL running quantity
    never complete anything; equal quantities complete (``>=``). Both orders must be total
    within a group. The result is a lazy plan: no job runs while it is built.

    ``whole`` > 0: groups in buckets of at most so many lines and receipts stay whole in one task and move
    once; the inputs are read once more, for their keys. All others (0: all groups) are spread over ranges.
    """
    keys = list(keys)
    lines = [c for c in sched.columns if c not in keys]

    def side(df: DataFrame, receipt: bool, qty: str, order: Sequence[Column], carried: Sequence[str], name: str) -> tuple[DataFrame, list[str]]:
        """The columns of one side under their common names, each once, and the names of its order."""
        held = {str(F.col(c)): f"{name}c{i}" for i, c in enumerate(carried)}
        ranks = [held.get(str(c), f"{name}o{i}") for i, c in enumerate(order)]
        return df.select(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)], F.lit(receipt).alias("receipt"), F.col(qty).alias("qty"),
                         *[c.alias(n) for c, n in zip(order, ranks, strict=True) if n.startswith(f"{name}o")],
                         *[F.col(c).alias(f"{name}c{i}") for i, c in enumerate(carried)]), ranks

    (lined, line_order), (posted, receipt_ranks) = side(sched, False, sched_qty, sched_order, lines, "s"), side(receipts, True, receipt_qty, receipt_order, receipt_cols, "r")
    events = lined.unionByName(posted, allowMissingColumns=True)
    key, payload = [f"k{i}" for i in range(len(keys))], [f"rc{i}" for i in range(len(receipt_cols))]
    order, own = [F.col(c) for c in line_order + receipt_ranks], [f"sc{i}" for i in range(len(lines))]
    if whole > 0:
        bucket = F.pmod(F.xxhash64(*key), F.lit(BUCKETS)).cast("int")
        large = F.broadcast(events.groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > whole).select("bucket"))
        found = _in_ranges(events.join(large, bucket == F.col("bucket"), "left_semi"), key, order, own, payload).unionByName(
            _in_windows(events.join(large, bucket == F.col("bucket"), "left_anti"), key, order, own, payload))
    else:
        found = _in_ranges(events, key, order, own, payload)
    best = F.when(F.col("cum").isNotNull(), F.col("best"))
    return found.select(*[F.col(f"k{i}").alias(k) for i, k in enumerate(keys)], *[F.col(o).alias(c) for o, c in zip(own, lines, strict=True)],
                        F.col("rank").alias(sched_rank), F.col("cum").alias(cum_sched), best["rank"].alias(gr_rank), best["cum"].alias(cum_gr),
                        *[best[p].alias(c) for p, c in zip(payload, receipt_cols, strict=True)])


def _falling() -> list[Column]:
    """Before a line come the receipts of at least its cumulative quantity."""
    return [F.col("cum").desc_nulls_last(), F.col("receipt").desc()]


def _in_ranges(events: DataFrame, key: list[str], order: list[Column], own: list[str], payload: list[str]) -> DataFrame:
    ranked = running_sums(events, [*key, "receipt"], order, {"cum": F.col("qty")}, "rank", kept=[*key, "receipt", *own, *payload])
    return earliest_offer(ranked.where(~F.col("receipt") | F.col("cum").isNotNull()), key, _falling(),
                          "receipt", "rank", ["cum", *payload], [*key, "rank", "cum", *own], "best")


def _in_windows(events: DataFrame, key: list[str], order: list[Column], own: list[str], payload: list[str]) -> DataFrame:
    dated = Window.partitionBy(*key, "receipt").orderBy(*order)
    falling = Window.partitionBy(*key).orderBy(*_falling()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = events.repartition(*key).withColumns({"rank": F.row_number().over(dated), "cum": F.sum("qty").over(dated.rowsBetween(Window.unboundedPreceding, Window.currentRow))})
    offered = F.when(F.col("receipt"), F.struct("rank", "cum", *payload))
    matched = ranked.where(~F.col("receipt") | F.col("cum").isNotNull()).withColumn("best", F.min(offered).over(falling))
    return matched.where(~F.col("receipt")).select(*key, "rank", "cum", *own, "best")
