"""martforge: supply-chain and finance reporting marts over raw ERP tables, built on PySpark.

Layout
------
functions/  column expressions (key normalisation, dates, flags, code decoding)
sources/    table access (catalog, parquet, driver-shaped fixtures), declared schemas, sinks
operators/  reusable DataFrame operators (latest-per-key, stacking, enrichment,
            cumulative completion matching, BOM dedup/explosion, ragged hierarchies)
plans/      the report and dimension marts, each ``build(src, cfg) -> DataFrame``
"""

from martforge.config import MartConfig

__all__ = ["MartConfig"]
