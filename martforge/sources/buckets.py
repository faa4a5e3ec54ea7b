"""Purchasing tables in equal buckets of their document number, so that their joins move no rows.

Headers, items, schedule lines and history records all carry the document number. Stored as tables with
the same number of buckets on it, the rows of a document lie in the same bucket of every table, and joins
on (document) as on (document, item) read bucket against bucket without an exchange.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from martforge.sources.base import Sources

DOCUMENT = "EBELN"
#: Tables of purchasing documents.
PURCHASING = ("EKKO", "EKPO", "EKET", "EKBE")
#: A join on (document, item) may then use a partitioning by document alone.
_PART_OF_KEYS = "spark.sql.requireAllClusterKeysForCoPartition"


class BucketedSources(Sources):
    """Sources whose purchasing tables are read from bucketed tables of ``database``; others come from ``inner``.

    Lets the session join on a part of the keys for as long as it lives (results are the same either way).
    """

    keeps_documents = True

    def __init__(self, inner: Sources, database: str, tables: Sequence[str] = PURCHASING) -> None:
        self.spark, self.inner, self.database, self.tables = inner.spark, inner, database, {t.upper() for t in tables}
        self.spark.conf.set(_PART_OF_KEYS, "false")

    def table(self, name: str) -> DataFrame:
        name = name.upper()
        return self.spark.table(f"{self.database}.{name}") if name in self.tables else self.inner.table(name)


def store_bucketed(src: Sources, database: str, buckets: int, tables: Sequence[str] = PURCHASING) -> BucketedSources:
    """Store ``tables`` of ``src`` in ``buckets`` buckets each, one file per bucket, sorted by document and item.

    A bucket should hold what one task can join: choose ``buckets`` by the largest table (about 128 MB each).
    Existing tables of the names are replaced.
    """
    for name in tables:
        df = src.table(name)
        order = [c for c in (DOCUMENT, "EBELP") if c in df.columns]
        (df.repartition(buckets, DOCUMENT).write.mode("overwrite").format("parquet").bucketBy(buckets, DOCUMENT).sortBy(*order)
         .saveAsTable(f"{database}.{name.upper()}"))
    return BucketedSources(src, database, tables)
