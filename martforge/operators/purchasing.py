"""Purchasing document lines: header -> item -> schedule line, with value and status."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martforge.config import MartConfig
from martforge.functions.columns import safe_div
from martforge.operators.combine import enrich
from martforge.sources.base import Sources


def in_doc_range(doc_range: tuple[str, str], col: str = "EBELN") -> Column:
    """Lexical range on the zero-padded document number (``'4500'`` is outside ``0004...``).

    Applied to every purchasing table, not only the header, so each scan prunes its own
    row groups instead of waiting for the join to drop the rows.
    """
    return F.col(col).between(*doc_range)


def line_status(deleted="LOEKZ", completed="ELIKZ", received="WEMNG", scheduled="line_qty") -> Column:
    """Deleted > Delivery Complete > Fully Received > Partially Received > Open (NULLs -> Open)."""
    return (F.when(F.col(deleted) == "X", "Deleted")
            .when(F.col(completed) == "X", "Delivery Complete")
            .when(F.col(received) >= F.col(scheduled), "Fully Received")
            .when(F.col(received) > 0, "Partially Received")
            .otherwise("Open"))


def line_value(qty="line_qty", price="NETPR", per="PEINH") -> Column:
    """round(qty * price / price_unit, 2); a zero or NULL price unit gives NULL."""
    return F.round(safe_div(F.col(qty) * F.col(price), F.col(per)), 2)


def look_up(src: Sources, df: DataFrame, dim: DataFrame, key: str, check_unique: bool = True) -> DataFrame:
    """``df`` (rows with a document number) with the columns of ``dim`` for ``key`` (left join, see :func:`enrich`).

    Rows of bucketed sources stay in their buckets: what a document asks for is looked up and sent to it.
    """
    if not src.keeps_documents:
        return enrich(df, dim, key, check_unique=check_unique)
    asked = df.where(F.col(key).isNotNull()).select(F.col("EBELN").alias("document"), F.col(key).alias("asked")).distinct()
    sent = enrich(asked, dim.withColumnRenamed(key, "asked"), "asked", "inner", check_unique).repartition("document")
    return df.join(sent, (F.col("EBELN") == F.col("document")) & (F.col(key) == F.col("asked")), "left").drop("document", "asked")


def purchasing_headers(src: Sources, cfg: MartConfig, doc_range: tuple[str, str], header_cols: list) -> DataFrame:
    """In-range headers with the company-code currency."""
    ekko = src.scoped("EKKO", cfg).filter(in_doc_range(doc_range)).select("EBELN", "BUKRS", *header_cols)
    t001 = src.scoped("T001", cfg).select("BUKRS", F.col("WAERS").alias("local_currency"))
    return look_up(src, ekko, t001, "BUKRS", check_unique=False)


#: Keys on which items, lines and headers meet.
PLACE = ["EBELN", "place"]


def item_place() -> Column:
    """Item number of an item as a key that is never NULL: without a number it meets no line, but its headers."""
    return F.coalesce(line_place(), F.lit("")).alias("place")


def line_place() -> Column:
    """Item number of a line as that key; a line without one meets no item."""
    return F.concat(F.lit("="), F.col("EBELP")).alias("place")


def with_headers(lines: DataFrame, headers: DataFrame, items: DataFrame) -> DataFrame:
    """``lines`` (already joined on :data:`PLACE`) with their headers (inner), as the last join.

    Headers, items and lines that share a number meet in every combination, so nothing may be moved or
    computed after this join. The headers go to each distinct item number of ``items`` once (as many
    rows as items if document numbers are unique), and the join shares the lines' exchange and order.
    """
    placed = items.select("EBELN", item_place()).distinct().join(headers, "EBELN", "inner")
    return lines.join(placed, PLACE, "inner")
