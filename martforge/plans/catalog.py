"""The 26 marts: build function, declared schema and table comment, plus a full refresh.

``refresh_marts`` is what a scheduled job runs: every mart is built from the sources,
projected onto its declared schema and written as a full refresh. Marts do not read each
other, so any subset can run in any order; most are one job, the explosion one per level.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from martforge.config import MartConfig
from martforge.plans import bom, codes, controlling, materials, partners, purchasing
from martforge.plans.comments import KEY, documented
from martforge.session import scratch
from martforge.sources.base import Sources
from martforge.sources.publish import refresh, refresh_table, with_registered_key
from martforge.sources.schemas import Col, conform
from martforge.sources.sinks import create_mart_tables, with_surrogate_key, write_mart


class Mart(NamedTuple):
    build: Callable[[Sources, MartConfig], DataFrame]
    schema: list[Col]
    comment: str
    keep_table_schema: bool = False
    listing: list[Col] | None = None  # with ``cfg.bom_depth_first``


MARTS: dict[str, Mart] = {
    "inventory": Mart(materials.inventory, materials.INVENTORY,
                      "Stock by material, plant, storage location and special-stock kind, valued at standard price"),
    "purchase_order": Mart(purchasing.purchase_order, purchasing.PURCHASE_ORDER,
                           "Standard purchase-order schedule lines with value and delivery status"),
    "stock_transfer": Mart(purchasing.stock_transfer, purchasing.STOCK_TRANSFER,
                           "Stock-transport-order schedule lines with supplying and receiving plant"),
    "material_reservation": Mart(materials.material_reservation, materials.MATERIAL_RESERVATION,
                                 "Open reservation items not flagged for deletion"),
    "purchase_requisition": Mart(purchasing.purchase_requisition, purchasing.PURCHASE_REQUISITION,
                                 "Requisition items with linked PO price and received quantity"),
    "approved_mfg_part_list": Mart(materials.approved_mfg_part_list, materials.APPROVED_MFG_PART_LIST,
                                   "Approved manufacturer parts by plant", keep_table_schema=True),
    "bill_of_materials": Mart(bom.bill_of_materials, bom.BILL_OF_MATERIALS,
                              "Multi-level bill-of-materials explosion", keep_table_schema=True,
                              listing=bom.BILL_OF_MATERIALS_LISTING),
    "material_details": Mart(materials.material_details, materials.MATERIAL_DETAILS,
                             "Material x plant master data with planning and valuation"),
    "material_usage": Mart(materials.material_usage, materials.MATERIAL_USAGE,
                           "Goods-movement history, one row per material document item"),
    "vendor_master": Mart(partners.vendor_master, partners.VENDOR_MASTER,
                          "Vendors by purchasing organisation with preferred e-mail"),
    "material_last_movement": Mart(materials.material_last_movement, materials.MATERIAL_LAST_MOVEMENT,
                                   "Most recent goods movement per material and plant"),
    "vendor_otd": Mart(purchasing.vendor_otd, purchasing.VENDOR_OTD,
                       "On-time delivery per PO schedule line by cumulative receipt matching"),
    "material_class": Mart(materials.material_class, materials.MATERIAL_CLASS,
                           "Material class by material type and procurement type"),
    "affiliate_customers": Mart(partners.affiliate_customers, partners.AFFILIATE_CUSTOMERS,
                                "Affiliated customer accounts with site label"),
    "affiliate_vendors": Mart(partners.affiliate_vendors, partners.AFFILIATE_VENDORS,
                              "Affiliated vendor accounts with site label"),
    "movement_type": Mart(codes.movement_type, codes.MOVEMENT_TYPE, "Movement types with text and category"),
    "payment_terms": Mart(codes.payment_terms, codes.PAYMENT_TERMS, "Payment terms with text"),
    "purchasing_groups": Mart(codes.purchasing_groups, codes.PURCHASING_GROUPS, "Purchasing groups (buyers)"),
    "so_document_type": Mart(codes.so_document_type, codes.SO_DOCUMENT_TYPE, "Sales document types with order type"),
    "so_item_category": Mart(codes.so_item_category, codes.SO_ITEM_CATEGORY, "Sales item categories with billing type"),
    "so_reject_codes": Mart(codes.so_reject_codes, codes.SO_REJECT_CODES, "Sales rejection reasons with status"),
    "storage_locations": Mart(codes.storage_locations, codes.STORAGE_LOCATIONS, "Storage locations of selected plants"),
    "delivery_blocks": Mart(codes.delivery_blocks, codes.DELIVERY_BLOCKS, "Delivery block codes"),
    "billing_blocks": Mart(codes.billing_blocks, codes.BILLING_BLOCKS, "Billing block codes"),
    "profit_center": Mart(controlling.profit_center, controlling.PROFIT_CENTER,
                          "Active profit centers with flattened hierarchy tiers"),
    "cost_center": Mart(controlling.cost_center, controlling.COST_CENTER, "Active cost centers with text"),
}


def create_tables(spark, database: str, fmt: str = "parquet") -> list[str]:
    """``CREATE DATABASE`` and one ``CREATE TABLE IF NOT EXISTS`` per mart: the key column, then the
    declared columns, each with a comment."""
    return create_mart_tables(spark, database, {n: ([KEY, *documented(m.schema)], m.comment) for n, m in MARTS.items()}, fmt)


def refresh_marts(src: Sources, cfg: MartConfig, target: str, names: Iterable[str] | None = None,
                  as_tables: bool = False, fmt: str = "parquet", surrogate_key: bool | None = None, published: bool = False,
                  key_registry: str | None = None, business_keys: Mapping[str, Sequence[str]] | None = None) -> dict[str, int]:
    """Full refresh of the named marts (all by default); returns the rows written per mart.

    ``target`` is a folder (one sub-folder per mart) or, with ``as_tables``, a database in
    which ``create_tables`` has run; marts declared with a fixed table schema are then
    replaced row-wise by name, the others overwritten. ``surrogate_key`` puts the key column
    in front (by default for tables only): dense numbers, or with ``key_registry`` (a folder) numbers that
    a business key (``business_keys`` per mart, all columns by default) keeps through all refreshes. ``published`` writes folders of versions for
    :func:`martforge.sources.publish.read_published`. A table that exists with the declared columns keeps its
    definition and is switched to its new rows at once. Rows are counted while they are written. What a
    mart stored in the shared folder on its way is removed once it is written.
    """
    keyed = as_tables if surrogate_key is None else surrogate_key
    done: dict[str, int] = {}
    for name in (list(names) if names is not None else list(MARTS)):
        mart = MARTS[name]
        with scratch(src.spark):
            schema = documented(mart.listing if mart.listing and cfg.bom_depth_first else mart.schema)
            df = conform(mart.build(src, cfg), schema)
            if keyed:
                names_of = [c.name for c in schema]
                df = (with_registered_key(df, (business_keys or {}).get(name, names_of), f"{key_registry.rstrip('/')}/{name}", KEY.name) if key_registry
                      else with_surrogate_key(df, names_of, KEY.name, "dense"))
                schema = [KEY, *schema]
            seen = Observation(f"refresh of {name}")
            df = df.observe(seen, F.count(F.lit(1)).alias("rows"))
            where = f"{target}.{name}" if as_tables else f"{target.rstrip('/')}/{name}"
            if published and not as_tables:
                refresh(df, where, schema, fmt)
            elif as_tables and fmt != "delta" and src.spark.catalog.tableExists(where) and src.spark.table(where).columns == [c.name for c in schema]:
                refresh_table(df, where, schema, fmt)
            else:
                write_mart(df, where, schema, fmt=fmt, table=as_tables, keep_table_schema=as_tables and mart.keep_table_schema and not (mart.listing and cfg.bom_depth_first))
            done[name] = seen.get["rows"]
    return done
