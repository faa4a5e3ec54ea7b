"""Code and text dimensions: movement types, payment terms, buyer groups, sales document
types, item categories, rejection codes, storage locations, delivery and billing blocks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martforge.config import MartConfig
from martforge.functions import codes as C
from martforge.functions.codes import decode_codes
from martforge.plans.common import strip
from martforge.operators.combine import enrich
from martforge.sources.base import Sources
from martforge.sources.schemas import cols, conform

MOVEMENT_TYPE = cols(["movement_type", "sap_description", "movement_type_text", "breakdown"])


def movement_type(src: Sources, cfg: MartConfig) -> DataFrame:
    """Movement types with system text, plain-language text and category; types without a
    plain-language text are left out. Distinct (code, text) pairs: a code with two texts
    keeps two rows."""
    texts = src.scoped("T156T", cfg, language=True).select("BWART", "BTEXT").distinct()
    df = src.scoped("T156", cfg).select("BWART").join(texts, "BWART", "left")
    out = df.select(
        F.col("BWART").alias("movement_type"), F.col("BTEXT").alias("sap_description"),
        decode_codes("BWART", C.MOVEMENT_TYPE_TEXT).alias("movement_type_text"),
        decode_codes("BWART", C.MOVEMENT_CATEGORY, "Unknown").alias("breakdown"))
    return conform(out.filter(F.col("movement_type_text").isNotNull()), MOVEMENT_TYPE)


PAYMENT_TERMS = cols(["payment_terms", "description", "baseline_date"])


def payment_terms(src: Sources, cfg: MartConfig) -> DataFrame:
    """Payment terms with text, one row per term and day limit (ZTAGG, where the tables have it)."""
    terms = src.scoped("T052", cfg)
    texts = src.scoped("T052U", cfg, language=True)
    key = [c for c in ("ZTERM", "ZTAGG") if c in terms.columns and c in texts.columns]
    df = enrich(terms, texts.groupBy(*key).agg(F.min("TEXT1").alias("TEXT1")), key)
    return conform(df.select(F.col("ZTERM").alias("payment_terms"), F.col("TEXT1").alias("description"),
                             F.col("ZTAG1").alias("baseline_date")), PAYMENT_TERMS)


PURCHASING_GROUPS = cols(["purchasing_group", "buyer_name"])


def purchasing_groups(src: Sources, cfg: MartConfig) -> DataFrame:
    return conform(src.scoped("T024", cfg).select(F.col("EKGRP").alias("purchasing_group"),
                                                  F.col("EKNAM").alias("buyer_name")), PURCHASING_GROUPS)


SO_DOCUMENT_TYPE = cols(["sales_doc_type", "description", "order_type"])


def so_document_type(src: Sources, cfg: MartConfig) -> DataFrame:
    texts = src.scoped("TVAKT", cfg, language=True).select("AUART", "BEZEI")
    df = src.scoped("TVAK", cfg).join(texts, "AUART", "left")
    return conform(df.select(
        F.col("AUART").alias("sales_doc_type"), F.col("BEZEI").alias("description"),
        decode_codes("AUART", C.ORDER_TYPE, C.ORDER_TYPE_DEFAULT).alias("order_type")), SO_DOCUMENT_TYPE)


SO_ITEM_CATEGORY = cols(["item_category", "description", "billing_type"])


def so_item_category(src: Sources, cfg: MartConfig) -> DataFrame:
    df = src.scoped("TVAPT", cfg, language=True)
    return conform(df.select(
        F.col("PSTYV").alias("item_category"), F.col("VTEXT").alias("description"),
        decode_codes("PSTYV", C.BILLING_TYPE, C.BILLING_TYPE_DEFAULT).alias("billing_type")), SO_ITEM_CATEGORY)


SO_REJECT_CODES = cols(["rejection_code", "description", "status"])


def so_reject_codes(src: Sources, cfg: MartConfig) -> DataFrame:
    df = src.scoped("TVAGT", cfg, language=True)
    return conform(df.select(
        F.col("ABGRU").alias("rejection_code"), F.col("BEZEI").alias("description"),
        decode_codes("ABGRU", C.REJECT_STATUS, C.REJECT_STATUS_DEFAULT).alias("status")), SO_REJECT_CODES)


STORAGE_LOCATIONS = cols(["plant", "storage_location", "description"])


def storage_locations(src: Sources, cfg: MartConfig) -> DataFrame:
    if not cfg.storage_plants:
        raise ValueError("MartConfig.storage_plants names the plants of this dimension")
    df = src.scoped("T001L", cfg).filter(F.col("WERKS").isin(*cfg.storage_plants))
    return conform(df.select(F.col("WERKS").alias("plant"), strip("LGORT", "storage_location"),
                             F.col("LGOBE").alias("description")), STORAGE_LOCATIONS)


DELIVERY_BLOCKS = cols(["delivery_block", "description"])
BILLING_BLOCKS = cols(["billing_block", "description"])


def delivery_blocks(src: Sources, cfg: MartConfig) -> DataFrame:
    df = src.scoped("TVLST", cfg, language=True)
    return conform(df.select(F.col("LIFSP").alias("delivery_block"), F.col("VTEXT").alias("description")),
                   DELIVERY_BLOCKS)


def billing_blocks(src: Sources, cfg: MartConfig) -> DataFrame:
    df = src.scoped("TVFST", cfg, language=True)
    return conform(df.select(F.col("FAKSP").alias("billing_block"), F.col("VTEXT").alias("description")),
                   BILLING_BLOCKS)
