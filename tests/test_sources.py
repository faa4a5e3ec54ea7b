import os

from martforge.plans import codes
from martforge.plans.registry import DRIVER_CONFIG
from martforge.session import checkpoint_dir
from martforge.sources.base import CatalogSources, ParquetSources, client_column
from martforge.sources.shape import DriverSources

SF = "/root/testdata/sf0.001"


def _expected(spark):
    return sorted((tuple(r) for r in codes.payment_terms(DriverSources(spark, SF), DRIVER_CONFIG).collect()), key=str)


def test_parquet_sources(spark):
    root = os.path.join(checkpoint_dir(spark), "parquet-sources")
    driver = DriverSources(spark, SF)
    for name in ("T052", "T052U"):
        driver.table(name).write.mode("overwrite").parquet(f"{root}/{name}")
    got = sorted((tuple(r) for r in codes.payment_terms(ParquetSources(spark, root), DRIVER_CONFIG).collect()), key=str)
    assert got == _expected(spark) and got


def test_catalog_sources(spark):
    db = "martforge_src_test"
    spark.sql(f"DROP DATABASE IF EXISTS {db} CASCADE")
    spark.sql(f"CREATE DATABASE {db} LOCATION '{os.path.join(checkpoint_dir(spark), 'src-db')}'")
    driver = DriverSources(spark, SF)
    for name in ("T052", "T052U"):
        driver.table(name).write.mode("overwrite").saveAsTable(f"{db}.{name}")
    got = sorted((tuple(r) for r in codes.payment_terms(CatalogSources(spark, db), DRIVER_CONFIG).collect()), key=str)
    assert got == _expected(spark) and got
    spark.sql(f"DROP DATABASE IF EXISTS {db} CASCADE")


def test_client_columns():
    assert client_column("ADR6") == "CLIENT"
    assert client_column("profit_center_hierarchy") is None
    assert client_column("EKKO") == "MANDT"
