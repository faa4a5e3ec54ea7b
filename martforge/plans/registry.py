"""Registered queries over the driver tables: one per mart / operator of the inventory.

Each entry is ``fn(spark, sf_dir) -> DataFrame``; the sources are the driver tables shaped
into ERP tables (``DriverSources``) and the configuration pins the as-of date so results
are reproducible. Oracle SQL for each key lives in ``oracle/queries.py``.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martforge.config import MartConfig
from martforge.functions.columns import strip_leading_zeros
from martforge.operators.hierarchy import childless_nodes
from martforge.operators.matching import completion_match, running_total
from martforge.operators.purchasing import in_doc_range
from martforge.plans import bom, codes, controlling, materials, partners, purchasing
from martforge.plans.comments import KEY, documented
from martforge.session import checkpoint_dir
from martforge.sources.base import Sources
from martforge.sources.buckets import store_bucketed
from martforge.sources.publish import CheckedSources, read_published, refresh, refresh_table, remove_old_versions, with_registered_key
from martforge.sources.schemas import QTY, QTY13
from martforge.sources.shape import DriverSources
from martforge.sources.sinks import create_mart_table, with_surrogate_key, write_mart

AS_OF = dt.date(2000, 1, 1)

# Synthetic affiliate configuration for the driver data (company data in a real deployment).
DRIVER_CONFIG = MartConfig(
    as_of=AS_OF,
    storage_plants=("4001", "4005", "4010"),
    controlling_area="CA01",
    customer_name_patterns=("er#0000001", "ER#0000005"),
    customer_labels={"0000000101": "SITE NORTH", "0000000150": "SITE NORTH", "C109": "SITE EAST",
                     "0000000512": "SITE WEST"},
    customer_excluded_name_prefix="BLK3",
    customer_excluded_number_part="FR",
    vendor_name_patterns=("ER#00000001", "er#00000004"),
    vendor_labels={"0000000010": "SITE NORTH", "0000000041": "SITE SOUTH", "0000000047": "SITE SOUTH"},
)


def _src(spark: SparkSession, sf_dir: str) -> Sources:
    return DriverSources(spark, sf_dir, stage=True)


def _mart(build) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return build(_src(spark, sf_dir), DRIVER_CONFIG)

    run.__name__ = getattr(build, "__name__", "mart")
    run.__doc__ = build.__doc__
    return run


def otd_status_by_vendor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Schedule lines and scheduled quantity per vendor and delivery status."""
    return purchasing.vendor_otd_totals(_src(spark, sf_dir), DRIVER_CONFIG)


def running_qty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Schedule rank and running scheduled quantity per PO item (due date, line counter)."""
    cfg = DRIVER_CONFIG
    eket = (_src(spark, sf_dir).scoped("EKET", cfg).filter(in_doc_range(cfg.po_range))
            .select("EBELN", "EBELP", "ETENR", "EINDT", F.col("MENGE").alias("sched_menge")))
    out = running_total(eket, ["EBELN", "EBELP"], [F.col("EINDT"), F.col("ETENR")], "sched_menge",
                        "cum_sched_qty", rank="sched_rank")
    return out.withColumn("cum_sched_qty", F.col("cum_sched_qty").cast(QTY))


def _completion_on_items(spark: SparkSession, sf_dir: str, item_cols) -> DataFrame:
    """Cumulative completion matching with larger items than purchase-order lines.

    Every line item is a schedule line of its item (due at the ship date, quantity as
    ordered); every line item not flagged 'N' is also a receipt 7 days after shipping.
    Orders are total: (date, order, line number, part).
    """
    li = _src(spark, sf_dir).raw("lineitem")
    base = li.select(*[c.alias(f"item_{i}") for i, c in enumerate(item_cols)],
                     F.col("l_orderkey").alias("ord"), F.col("l_linenumber").alias("line"),
                     F.col("l_partkey").alias("part"), F.col("l_shipdate").cast("date").alias("due"),
                     F.col("l_quantity").cast(QTY).alias("qty"), F.col("l_returnflag").alias("flag"))
    keys = [f"item_{i}" for i in range(len(item_cols))]
    sched = base.select(*keys, "ord", "line", "part", "due", "qty")
    receipts = base.filter(F.col("flag") != "N").select(
        *keys, F.col("ord").alias("r_ord"), F.col("line").alias("r_line"), F.col("part").alias("r_part"),
        F.date_add("due", 7).alias("received"), F.col("qty").alias("r_qty"))
    out = completion_match(sched, receipts, keys, [F.col("due"), F.col("ord"), F.col("line"), F.col("part")], "qty",
                           [F.col("received"), F.col("r_ord"), F.col("r_line"), F.col("r_part")], "r_qty",
                           ["received", "r_ord", "r_line"])
    return out.select(*keys, "ord", "line", "part", "sched_rank", F.col("cum_sched_qty").cast(QTY).alias("cum_sched_qty"),
                      "gr_rank", F.col("cum_gr_qty").cast(QTY).alias("cum_gr_qty"), "received", "r_ord", "r_line")


def completion_dense_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Completion matching with items (supplier, part % 20): about 30 lines per item."""
    return _completion_on_items(spark, sf_dir, [F.col("l_suppkey"), F.col("l_partkey") % 20])


def completion_supplier_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Completion matching with one item per supplier: about 600 lines per item."""
    return _completion_on_items(spark, sf_dir, [F.col("l_suppkey")])


def completion_hot_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Completion matching with two items (line status): each holds a large share of all lines."""
    return _completion_on_items(spark, sf_dir, [F.col("l_linestatus")])


def bom_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Multi-level explosion aggregated by level: rows and summed per-parent quantity."""
    exploded = bom.bill_of_materials(_src(spark, sf_dir), DRIVER_CONFIG)
    return exploded.groupBy("bom_level").agg(F.count(F.lit(1)).alias("rows"),
                                             F.sum("qty").cast("decimal(18,3)").alias("qty"))


def bom_depth_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Depth-first listing of the explosion with its sort path."""
    return bom.bill_of_materials(_src(spark, sf_dir), replace(DRIVER_CONFIG, bom_depth_first=True))


def bom_dedup_plant_scope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deduplicated direct BOM with layers 2-4 within BOM number, plant and parent."""
    return bom.bom_deduplicated(_src(spark, sf_dir), replace(DRIVER_CONFIG, bom_dedup_scope="bom_plant"))


def bom_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Explosion under the optional run-time filters on plant and usage."""
    return bom.bill_of_materials(_src(spark, sf_dir), replace(DRIVER_CONFIG, bom_filter_plant="1001", bom_filter_usage="1"))


def bom_from_materials(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Explosion of a long list of start materials: those of the company's own types (Z...)."""
    src = _src(spark, sf_dir)
    starts = src.scoped("MARA", DRIVER_CONFIG).where(F.col("MTART").startswith("Z")).select(strip_leading_zeros(F.col("MATNR")))
    return bom.bill_of_materials(src, replace(DRIVER_CONFIG, bom_filter_material=starts))


def leaf_nodes_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Level-3 nodes of the organisation tree without level-4 children."""
    tree = _src(spark, sf_dir).table("PROFIT_CENTER_HIERARCHY")
    return childless_nodes(tree).where(F.col("LEVEL") == "3").select(F.col("CHILD").alias("node"), F.col("CHILD_DESC").alias("description"),
                                           F.col("PARENT").alias("parent"))


def strip_zeros_both(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Material numbers with leading zeros stripped, plain and keeping one zero."""
    mara = _src(spark, sf_dir).scoped("MARA", DRIVER_CONFIG)
    return mara.select(F.col("MATNR").alias("material_key"), strip_leading_zeros(F.col("MATNR")).alias("stripped"),
                       strip_leading_zeros(F.col("MATNR"), keep_zero=True).alias("stripped_keep_zero"))


def surrogate_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vendor master with a dense surrogate key in business-key order."""
    vm = partners.vendor_master(_src(spark, sf_dir), DRIVER_CONFIG)
    return with_surrogate_key(vm, ["vendor_account_number", "purchasing_organization"], method="dense")


def write_mart_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Full-refresh write of the vendor master to the shared scratch folder, read back."""
    target = f"{checkpoint_dir(spark).rstrip('/')}/marts/vendor_master-{uuid.uuid4().hex}"
    write_mart(partners.vendor_master(_src(spark, sf_dir), DRIVER_CONFIG), target, schema=partners.VENDOR_MASTER)
    return spark.read.parquet(target)


def _fresh(spark: SparkSession, label: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/marts/{label}-{uuid.uuid4().hex}"


def published_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The vendor master published twice, first a part of it, and read back."""
    vm, base = partners.vendor_master(_src(spark, sf_dir), DRIVER_CONFIG), _fresh(spark, "published")
    refresh(vm.where(F.col("purchasing_organization") == "4000"), base, partners.VENDOR_MASTER)
    refresh(vm, base, partners.VENDOR_MASTER)
    remove_old_versions(spark, base)
    return read_published(spark, base)


def stable_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys of the vendor master after two refreshes: one organisation first, then all."""
    vm, registry = partners.vendor_master(_src(spark, sf_dir), DRIVER_CONFIG), _fresh(spark, "vendor-keys")
    keys = ["vendor_account_number", "purchasing_organization"]
    with_registered_key(vm.where(F.col("purchasing_organization") == "4001"), keys, registry)
    return with_registered_key(vm, keys, registry)


class _DirtyLines(DriverSources):
    """The driver's tables with malformed quantities planted in some schedule lines (as strings)."""

    def table(self, name: str) -> DataFrame:
        df = super().table(name)
        if name.upper() != "EKET":
            return df
        digit, item = F.substring("EBELN", 10, 1), F.col("EBELP")
        return (df.withColumn("MENGE", F.when((digit == "7") & (item == "00010"), "12,5 EA").when((digit == "5") & (item == "00030"), " ")
                              .otherwise(F.col("MENGE").cast("string")))
                .withColumn("WEMNG", F.when((digit == "3") & (item == "00020"), "99999999999999").otherwise(F.col("WEMNG").cast("string"))))


def _checked(spark: SparkSession, sf_dir: str) -> CheckedSources:
    return CheckedSources(_DirtyLines(spark, sf_dir, stage=True), {"EKET": {"MENGE": QTY13, "WEMNG": QTY13}}, _fresh(spark, "rejects"),
                          {"EKET": ["MANDT", "EBELN", "EBELP", "ETENR"]})


def quarantined_po_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchase order lines from sources with malformed quantities: their rows are set aside."""
    return purchasing.purchase_order(_checked(spark, sf_dir), DRIVER_CONFIG)


def rejected_schedule_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The schedule lines set aside, one row per reason."""
    return _checked(spark, sf_dir).rejected("EKET").select("MANDT", "EBELN", "EBELP", "ETENR", F.inline("reasons"))


def table_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A created catalog table filled by name with its key column, switched to new rows, and read back."""
    database = f"martforge_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{_fresh(spark, 'tables')}'")
    name, schema = f"{database}.approved_mfg_part_list", [KEY, *documented(materials.APPROVED_MFG_PART_LIST)]
    create_mart_table(spark, name, schema, "Approved parts")
    rows = with_surrogate_key(materials.approved_mfg_part_list(_src(spark, sf_dir), DRIVER_CONFIG), [c.name for c in schema[1:]], KEY.name, "dense")
    turned = rows.select(*reversed(rows.columns))
    write_mart(turned.limit(5), name, schema, table=True, keep_table_schema=True)
    refresh_table(turned, name, schema)
    return spark.table(name)


def po_lines_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchase order lines from purchasing tables stored in equal buckets of the document number."""
    database = f"martforge_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{_fresh(spark, 'buckets')}'")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return purchasing.purchase_order(store_bucketed(_src(spark, sf_dir), database, buckets, ["EKKO", "EKPO", "EKET"]), DRIVER_CONFIG)


def bom_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The depth-first listing stored in ranges of its sort order, read back."""
    base = _fresh(spark, "listing")
    refresh(bom.bill_of_materials(_src(spark, sf_dir), replace(DRIVER_CONFIG, bom_depth_first=True), ordered=False), base,
            bom.BILL_OF_MATERIALS_LISTING, layout=["top_material", "top_plant", "sort_path"])
    return read_published(spark, base)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    # purchasing
    "otd_completion": _mart(purchasing.vendor_otd),
    "otd_status_by_vendor": otd_status_by_vendor,
    "running_qty": running_qty,
    "completion_dense_items": completion_dense_items,
    "completion_supplier_items": completion_supplier_items,
    "completion_hot_items": completion_hot_items,
    "po_lines_status": _mart(purchasing.purchase_order),
    "sto_lines_status": _mart(purchasing.stock_transfer),
    "pr_gr_linkage": _mart(purchasing.purchase_requisition),
    # materials
    "inventory_union_value": _mart(materials.inventory),
    "material_details": _mart(materials.material_details),
    "goods_movements": _mart(materials.material_usage),
    "last_movement": _mart(materials.material_last_movement),
    "reservations_open": _mart(materials.material_reservation),
    "approved_parts": _mart(materials.approved_mfg_part_list),
    "class_cross": _mart(materials.material_class),
    # partners
    "vendor_preferred_contact": _mart(partners.vendor_master),
    "affiliates_customers": _mart(partners.affiliate_customers),
    "affiliates_vendors": _mart(partners.affiliate_vendors),
    # bill of materials
    "bom_dedup_layers": _mart(bom.bom_deduplicated),
    "bom_explosion": _mart(bom.bill_of_materials),
    "bom_levels": bom_levels,
    "bom_depth_first": bom_depth_first,
    "bom_dedup_plant_scope": bom_dedup_plant_scope,
    "bom_filtered": bom_filtered,
    "bom_from_materials": bom_from_materials,
    # controlling
    "hierarchy_ragged": _mart(controlling.profit_center),
    "leaf_nodes_anti": leaf_nodes_anti,
    "active_validity": _mart(controlling.cost_center),
    # code and text dimensions
    "code_lookup_required": _mart(codes.movement_type),
    "code_lookup_default": _mart(codes.so_item_category),
    "so_reject_codes": _mart(codes.so_reject_codes),
    "so_document_type": _mart(codes.so_document_type),
    "text_dim_left": _mart(codes.payment_terms),
    "code_text_dim": _mart(codes.billing_blocks),
    "delivery_blocks": _mart(codes.delivery_blocks),
    "purchasing_groups": _mart(codes.purchasing_groups),
    "plants_in_list": _mart(codes.storage_locations),
    # column functions and sinks
    "strip_zeros_both": strip_zeros_both,
    "surrogate_key": surrogate_key,
    "write_mart_roundtrip": write_mart_roundtrip,
    "published_refresh": published_refresh,
    "stable_keys": stable_keys,
    "quarantined_po_lines": quarantined_po_lines,
    "rejected_schedule_lines": rejected_schedule_lines,
    "table_refresh": table_refresh,
    "po_lines_bucketed": po_lines_bucketed,
    "bom_listing": bom_listing,
}
