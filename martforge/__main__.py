"""Command line: full refresh of the marts.

    spark-submit -m martforge --parquet-sources /lake/erp --target /lake/marts [--marts a,b] [--as-of 2024-01-01]
    spark-submit -m martforge --catalog-schema erp --target marts_db --as-tables --create-tables
"""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import SparkSession

from martforge.config import MartConfig
from martforge.plans.catalog import create_tables, refresh_marts
from martforge.sources.base import CatalogSources, ParquetSources


def main(argv=None) -> None:
    p = argparse.ArgumentParser(prog="martforge")
    src = p.add_mutually_exclusive_group(required=True)
    src.add_argument("--parquet-sources", help="folder with one parquet dataset per ERP table")
    src.add_argument("--catalog-schema", help="schema (or catalog.schema) holding the ERP tables")
    p.add_argument("--target", required=True, help="output folder, or database with --as-tables")
    p.add_argument("--as-tables", action="store_true")
    p.add_argument("--create-tables", action="store_true", help="create the documented tables first")
    p.add_argument("--marts", help="comma-separated subset")
    p.add_argument("--client", default="400")
    p.add_argument("--language", default="E")
    p.add_argument("--as-of", help="reference date (default: today)")
    p.add_argument("--surrogate-key", action="store_true", help="put the key column in front (always done for tables)")
    p.add_argument("--bom-depth-first", action="store_true", help="write the explosion with its sort path, depth first")
    p.add_argument("--published", action="store_true", help="write versions that are published atomically")
    p.add_argument("--key-registry", help="folder of key registries: rows keep their keys through all refreshes")
    a = p.parse_args(argv)
    spark = SparkSession.builder.appName("martforge-refresh").getOrCreate()
    if a.parquet_sources:
        sources = ParquetSources(spark, a.parquet_sources)
    else:
        catalog, _, schema = a.catalog_schema.rpartition(".")
        sources = CatalogSources(spark, schema, catalog or None)
    cfg = MartConfig(client=a.client, language=a.language,
                     as_of=dt.date.fromisoformat(a.as_of) if a.as_of else None, bom_depth_first=a.bom_depth_first)
    if a.create_tables:
        create_tables(spark, a.target)
    names = a.marts.split(",") if a.marts else None
    for name, rows in refresh_marts(sources, cfg, a.target, names, as_tables=a.as_tables, surrogate_key=a.surrogate_key or bool(a.key_registry) or None,
                                    published=a.published, key_registry=a.key_registry).items():
        print(f"refreshed {name}: {rows} rows")


if __name__ == "__main__":
    main()
