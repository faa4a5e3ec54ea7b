"""Access to raw ERP tables.

A mart never names a catalog, schema or path: it asks a ``Sources`` object for a table by
its ERP name and scopes it with the configuration. Three implementations:

* ``CatalogSources`` - tables in a metastore catalog/schema (the production layout);
* ``ParquetSources`` - one parquet dataset per table under a root folder;
* ``DriverSources`` (sources/shape.py) - ERP-shaped tables derived from the TPC-H-like driver
  tables, used by the oracle checks and the benchmark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martforge.config import MartConfig

# Tables whose client column is not MANDT, and tables with no client column at all.
CLIENT_COLUMN = {"ADR6": "CLIENT"}
UNSCOPED_TABLES = {"PROFIT_CENTER_HIERARCHY"}


class Sources:
    """Base class: subclasses implement ``_load(name)``."""

    spark: SparkSession
    #: Whether the rows of a purchasing document lie together in storage and joins should leave them there.
    keeps_documents = False

    def _load(self, name: str) -> DataFrame:  # pragma: no cover - abstract
        raise NotImplementedError

    def table(self, name: str) -> DataFrame:
        return self._load(name.upper())

    def scoped(self, name: str, cfg: MartConfig, language: bool = False) -> DataFrame:
        """Table filtered to the configured client (and language for text tables)."""
        df = self.table(name)
        df = scope_client(df, cfg.client, client_column(name))
        if language:
            df = scope_language(df, cfg.language)
        return df


def client_column(name: str) -> str | None:
    name = name.upper()
    if name in UNSCOPED_TABLES:
        return None
    return CLIENT_COLUMN.get(name, "MANDT")


def scope_client(df: DataFrame, client: str, column: str | None = "MANDT") -> DataFrame:
    """Keep one client's rows. The equality is pushed into the scan as a parquet filter."""
    if column is None:
        return df
    return df.filter(F.col(column) == client)


def scope_language(df: DataFrame, language: str, column: str = "SPRAS") -> DataFrame:
    return df.filter(F.col(column) == language)


class CatalogSources(Sources):
    """Tables read by name from ``catalog.schema`` (or just ``schema``) in the session catalog."""

    def __init__(self, spark: SparkSession, schema: str, catalog: str | None = None):
        self.spark = spark
        self.prefix = f"`{catalog}`.`{schema}`" if catalog else f"`{schema}`"

    def _load(self, name: str) -> DataFrame:
        return self.spark.table(f"{self.prefix}.`{name}`")


class ParquetSources(Sources):
    """One parquet dataset per table: ``<root>/<NAME>`` (upper-case ERP name)."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def _load(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/{name}")


class FrameSources(Sources):
    """Tables given as DataFrames (unit tests, notebooks): ``FrameSources(spark, {"EKKO": df, ...})``."""

    def __init__(self, spark: SparkSession, frames: dict[str, DataFrame]):
        self.spark = spark
        self.frames = {k.upper(): v for k, v in frames.items()}

    def _load(self, name: str) -> DataFrame:
        return self.frames[name]
