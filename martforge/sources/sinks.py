"""Sinks: full-refresh writes with declared schemas, table DDL with comments, surrogate keys."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from martforge.sources.schemas import Col, conform, struct_type


def write_mart(df: DataFrame, target: str, schema: Sequence[Col] | None = None, fmt: str = "parquet",
               table: bool = False, keep_table_schema: bool = False) -> None:
    """Full refresh of one mart.

    ``target`` is a path (``table=False``) or a table name. Rows at a path are replaced once all new ones are
    written; :mod:`martforge.sources.publish` replaces them atomically. With ``schema`` the frame is
    first projected onto the declared columns and types. ``keep_table_schema`` replaces the
    rows of an existing table without touching its definition, matching columns by name
    (``INSERT OVERWRITE ... BY NAME``; a positional insert could silently swap columns).
    """
    if schema is not None:
        df = conform(df, schema)
    if table and keep_table_schema:
        view = f"__martforge_src_{uuid.uuid4().hex}"
        df.createOrReplaceTempView(view)
        try:
            df.sparkSession.sql(f"INSERT OVERWRITE TABLE {target} BY NAME SELECT * FROM {view}")
        finally:
            df.sparkSession.catalog.dropTempView(view)
        return
    writer = df.write.format(fmt).mode("overwrite")
    if fmt == "delta":
        writer = writer.option("overwriteSchema", "true")
    if table:
        writer.saveAsTable(target)
    elif fmt == "delta":  # its log swaps atomically
        writer.save(target)
    else:
        _replace_folder(df, target.rstrip("/"), fmt)


def _replace_folder(df: DataFrame, target: str, fmt: str) -> None:
    """Write all rows beside ``target``, then move them into its place: a job that fails leaves the old rows.

    Between the two moves ``target`` is missing for a moment; :mod:`martforge.sources.publish` has no such moment.
    """
    spark = df.sparkSession
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fresh, old = path(f"{target}.new-{uuid.uuid4().hex}"), path(f"{target}.old-{uuid.uuid4().hex}")
    here = path(target)
    fs = here.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    try:
        df.write.format(fmt).save(fresh.toString())
        had = fs.exists(here)
        if had and not fs.rename(here, old):
            raise OSError(f"cannot move {target} aside")
        if not fs.rename(fresh, here):
            if had:
                fs.rename(old, here)
            raise OSError(f"cannot move the new rows to {target}")
    finally:
        if fs.exists(fresh):
            fs.delete(fresh, True)
    if had:
        fs.delete(old, True)


def create_mart_table(spark: SparkSession, name: str, schema: Sequence[Col], comment: str = "",
                      fmt: str = "parquet", location: str | None = None) -> None:
    """``CREATE TABLE IF NOT EXISTS`` with column and table comments."""
    st = struct_type(schema)
    col_sql = ",\n  ".join(
        f"`{f.name}` {f.dataType.simpleString()}"
        + (f" COMMENT '{f.metadata['comment'].replace(chr(39), chr(39) * 2)}'" if f.metadata.get("comment") else "")
        for f in st.fields)
    sql = f"CREATE TABLE IF NOT EXISTS {name} (\n  {col_sql}\n) USING {fmt}"
    if comment:
        sql += f" COMMENT '{comment.replace(chr(39), chr(39) * 2)}'"
    if location:
        sql += f" LOCATION '{location}'"
    spark.sql(sql)


def create_mart_tables(spark: SparkSession, database: str, marts: dict, fmt: str = "parquet") -> list[str]:
    """Create the database and one table per mart: ``marts`` maps name -> (schema, comment)."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    names = []
    for name, (schema, comment) in marts.items():
        full = f"{database}.{name}"
        create_mart_table(spark, full, schema, comment, fmt)
        names.append(full)
    return names


def with_surrogate_key(df: DataFrame, keys: Sequence[str], name: str = "surrogate_id", method: str = "hash") -> DataFrame:
    """Prepend a BIGINT surrogate key.

    ``hash``: ``xxhash64`` of the business key - stable across refreshes, computed per row,
    no shuffle. ``dense``: 1..N in business-key order. The frame is range-partitioned and
    sorted by the keys and checkpointed (so partition contents are fixed); each partition
    numbers its rows locally, a per-partition row count (one row per partition, a bound
    known in advance) gives each partition its offset, and the offsets are broadcast back.
    No single task sees all rows.
    """
    if method == "hash":
        return df.select(F.xxhash64(*[F.col(k) for k in keys]).alias(name), *df.columns)
    if method != "dense":
        raise ValueError("method must be 'hash' or 'dense'")
    from martforge.session import checkpoint_dir

    checkpoint_dir(df.sparkSession)
    ordered = df.orderBy(*[F.col(k).asc_nulls_first() for k in keys]).checkpoint(eager=True)
    tagged = ordered.select(*ordered.columns, F.spark_partition_id().alias("__pid"),
                            F.monotonically_increasing_id().alias("__mid"))
    counts = tagged.groupBy("__pid").agg(F.count(F.lit(1)).alias("__n"))
    offsets = counts.select("__pid", F.coalesce(F.sum("__n").over(
        Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__off"))
    local = F.col("__mid") - F.shiftleft(F.col("__pid").cast("long"), 33)
    numbered = tagged.join(F.broadcast(offsets), "__pid")
    return numbered.select((F.col("__off") + local + 1).alias(name), *df.columns)
