"""Run-time parameters shared by every mart.

The two scoping constants (client and language) and every range, list and date that a
mart depends on live here, so a mart is a pure function of (sources, config).
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, field

from pyspark.sql import DataFrame


@dataclass(frozen=True)
class MartConfig:
    client: str = "400"
    language: str = "E"
    # Reference date for "today" comparisons (open vs overdue, valid-from, age in days).
    # None means current_date() at run time; tests and oracle checks pin a literal date.
    as_of: _dt.date | None = None
    # Lexical document-number ranges on the zero-padded EBELN.
    po_range: tuple[str, str] = ("0004000000", "0004999999")
    sto_range: tuple[str, str] = ("0003000000", "0003999999")
    # Plants of the storage-location dimension; the deployment must name them.
    storage_plants: tuple[str, ...] = ()
    # Special-stock indicators kept from vendor stock (MSSL).
    vendor_stock_kinds: tuple[str, ...] = ("O", "V")
    # Controlling area of the profit centers; the deployment must name it.
    controlling_area: str | None = None
    # Bill of materials.
    # Levels of the explosion; None returns every level (cycles end at their closing row).
    bom_max_levels: int | None = None
    # Start materials of the explosion: a tuple of any length, or a frame with one column; None: all.
    bom_filter_material: tuple[str, ...] | DataFrame | None = None
    bom_filter_plant: str | None = None
    bom_filter_usage: str | None = None
    # "bom" keeps the reference's layer scope (partition by BOM number only);
    # "bom_plant" adds the plant and parent to layers 2-4.
    bom_dedup_scope: str = "bom"
    # Add sort_path to the mart and write it in depth-first order.
    bom_depth_first: bool = False
    # Company-specific affiliate detection: substrings of the upper-cased name and
    # account -> site label maps. Supplied by the deployment; defaults are synthetic.
    customer_name_patterns: tuple[str, ...] = ()
    customer_labels: dict = field(default_factory=dict)
    customer_excluded_name_prefix: str | None = None
    customer_excluded_number_part: str | None = None
    vendor_name_patterns: tuple[str, ...] = ()
    vendor_labels: dict = field(default_factory=dict)

    def as_of_col(self):
        from pyspark.sql import functions as F

        if self.as_of is None:
            return F.current_date()
        return F.lit(self.as_of)
