"""Small shared pieces of the mart plans: text lookups by key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martforge.config import MartConfig
from martforge.sources.base import Sources


def material_texts(src: Sources, cfg: MartConfig) -> DataFrame:
    """MATNR -> MAKTX in the configured client and language (one row per material)."""
    return src.scoped("MAKT", cfg, language=True).select("MATNR", "MAKTX")


def vendor_names(src: Sources, cfg: MartConfig) -> DataFrame:
    return src.scoped("LFA1", cfg).select("LIFNR", "NAME1")


def material_attrs(src: Sources, cfg: MartConfig, *cols: str) -> DataFrame:
    return src.scoped("MARA", cfg).select("MATNR", *cols)


def sort_merged(df: DataFrame) -> DataFrame:
    """Marks a table that grows with the materials, so that its joins sort and merge.

    The planner takes the size of Parquet files for that of the rows. Columns of few values take next to
    no room there, so millions of rows would pass for a small table and be broadcast through the driver.
    """
    return df.hint("merge")


def strip(col: str, alias: str | None = None):
    from martforge.functions.columns import strip_leading_zeros

    return strip_leading_zeros(F.col(col)).alias(alias or col)
