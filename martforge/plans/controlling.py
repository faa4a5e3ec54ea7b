"""Controlling dimensions: profit centers (with a flattened ragged hierarchy) and cost centers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martforge.config import MartConfig
from martforge.operators.hierarchy import ragged_hierarchy
from martforge.operators.select import active_only
from martforge.plans.common import strip
from martforge.sources.base import Sources
from martforge.sources.schemas import cols, conform

PROFIT_CENTER = cols([
    "profit_center", "description", "lock_indicator", "level_3_dept", "level_3_dept_desc", "level_2_site",
    "level_2_site_desc", "level_1_top", "level_1_top_desc",
])

#: Columns of the tree's levels above the leaves.
TIERS = {3: ("level_3_dept", "level_3_dept_desc"), 2: ("level_2_site", "level_2_site_desc"), 1: ("level_1_top", "level_1_top_desc")}


def profit_center(src: Sources, cfg: MartConfig) -> DataFrame:
    """Active profit centers of the controlling area with text and hierarchy tiers.

    Leaves are level-4 nodes (department, site, top above them) and level-3 nodes without
    children (site and top; no department). Centers absent from the tree keep NULL tiers.
    """
    if not cfg.controlling_area:
        raise ValueError("MartConfig.controlling_area names the controlling area of this dimension")
    area = F.col("KOKRS") == cfg.controlling_area
    cepc = active_only(src.scoped("CEPC", cfg).filter(area)).select("PRCTR", "LOCK_IND")
    cepct = active_only(src.scoped("CEPCT", cfg, language=True).filter(area)).select("PRCTR", "KTEXT")
    tiers = ragged_hierarchy(src.table("PROFIT_CENTER_HIERARCHY"), TIERS).withColumnRenamed("node", "PRCTR")
    df = cepc.join(cepct, "PRCTR", "left").join(tiers, "PRCTR", "left")
    return conform(df.select(
        F.col("PRCTR").alias("profit_center"), F.col("KTEXT").alias("description"),
        F.col("LOCK_IND").alias("lock_indicator"), "level_3_dept", "level_3_dept_desc", "level_2_site",
        "level_2_site_desc", "level_1_top", "level_1_top_desc",
    ), PROFIT_CENTER)


COST_CENTER = cols(["cost_center", "description", "controlling_area", "responsible_person", "department"])


def cost_center(src: Sources, cfg: MartConfig) -> DataFrame:
    """Active cost centers (open-ended validity) with the text of the same validity period."""
    csks = active_only(src.scoped("CSKS", cfg)).select("KOSTL", "KOKRS", "DATBI", "VERAK", "ABTEI")
    cskt = src.scoped("CSKT", cfg, language=True).select("KOSTL", "KOKRS", "DATBI", "KTEXT")
    df = csks.join(cskt, ["KOSTL", "KOKRS", "DATBI"], "left")
    return conform(df.select(
        strip("KOSTL", "cost_center"), F.col("KTEXT").alias("description"), F.col("KOKRS").alias("controlling_area"),
        F.col("VERAK").alias("responsible_person"), F.col("ABTEI").alias("department"),
    ), COST_CENTER)
