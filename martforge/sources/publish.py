"""Atomic refresh of stored marts: write a fresh version, then publish it in one step.

A mart is a folder::

    <base>/version-<id>/        the rows of one refresh, never changed afterwards
    <base>/_published/<n>-<id>  an empty file: the n-th publication made version <id> current

Phase one writes all rows into a version folder of its own; readers do not see it. Phase two creates one
empty file, which a file system or object store does atomically. Readers take the version of the last
publication, so they see the old rows until that moment and the new ones after it; a refresh that fails
half-way leaves the old ones. A table is published by one change of its location.

Versions stay until :func:`remove_old_versions`, so a reader that began before a publication can end.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from martforge.sources.base import Sources
from martforge.sources.schemas import Col, conform

_PUBLISHED = "_published"


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _names(spark: SparkSession, folder: str) -> list[str]:
    fs, p = _fs(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def _delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def published_version(spark: SparkSession, base: str) -> str | None:
    """Path of the version that readers see, or None before the first publication."""
    marks = _names(spark, f"{base}/{_PUBLISHED}")
    return f"{base}/version-{marks[-1].split('-', 1)[1]}" if marks else None


def write_version(df: DataFrame, base: str, schema: Sequence[Col] | None = None, fmt: str = "parquet",
                  layout: Sequence[str] = (), files: int | None = None) -> str:
    """Phase one: all rows in a version folder that no reader sees yet; returns its path.

    ``layout`` deals the rows to files by ranges of these columns and sorts them inside, so that a filter
    on a prefix of them skips files and row groups; no task sorts everything. ``files`` is their number
    (by default the planner chooses it by size). A version that cannot be written is removed.
    """
    if schema is not None:
        df = conform(df, schema)
    if layout:
        order = [F.col(c).asc_nulls_first() for c in layout]
        df = (df.repartitionByRange(files, *order) if files else df.repartitionByRange(*order)).sortWithinPartitions(*order)
    path = f"{base}/version-{uuid.uuid4().hex}"
    try:
        df.write.format(fmt).mode("errorifexists").save(path)
    except BaseException:
        _delete(df.sparkSession, path)
        raise
    return path


def publish(spark: SparkSession, base: str, version: str) -> None:
    """Phase two: make a written version the current one."""
    marks = _names(spark, f"{base}/{_PUBLISHED}")
    n = int(marks[-1].split("-", 1)[0]) + 1 if marks else 1
    fs, p = _fs(spark, f"{base}/{_PUBLISHED}/{n:012d}-{version.rpartition('/version-')[2]}")
    fs.create(p, False).close()


def refresh(df: DataFrame, base: str, schema: Sequence[Col] | None = None, fmt: str = "parquet", layout: Sequence[str] = ()) -> str:
    """Both phases for one mart; returns the path of its new version."""
    base = base.rstrip("/")
    path = write_version(df, base, schema, fmt, layout)
    publish(df.sparkSession, base, path)
    return path


@contextmanager
def refresh_together(spark: SparkSession) -> Iterator[dict[str, str]]:
    """Marts that belong together: fill the mapping base -> written version; all are published at the end, or none.

    If anything inside fails, the versions written so far are removed and nothing is published.
    """
    written: dict[str, str] = {}
    try:
        yield written
    except BaseException:
        for path in written.values():
            _delete(spark, path)
        raise
    for base, path in written.items():
        publish(spark, base, path)


def read_published(spark: SparkSession, base: str, fmt: str = "parquet") -> DataFrame:
    """The current rows of a mart."""
    version = published_version(spark, base.rstrip("/"))
    if version is None:
        raise FileNotFoundError(f"{base}: nothing has been published")
    return spark.read.format(fmt).load(version)


def remove_old_versions(spark: SparkSession, base: str, keep: int = 1) -> list[str]:
    """Delete versions but for the last ``keep`` published ones (the current one among them); returns their names.

    Versions that were never published count as old: run it when no refresh is writing.
    """
    base = base.rstrip("/")
    marks = _names(spark, f"{base}/{_PUBLISHED}")
    stay = {f"version-{m.split('-', 1)[1]}" for m in marks[-max(1, keep):]}
    gone = [v for v in _names(spark, base) if v.startswith("version-") and v not in stay] if marks else []
    for m in marks[:-max(1, keep)]:
        _delete(spark, f"{base}/{_PUBLISHED}/{m}")
    for v in gone:
        _delete(spark, f"{base}/{v}")
    return gone


def _location(spark: SparkSession, table: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'").collect()
    return rows[0]["data_type"].rstrip("/")


def refresh_table(df: DataFrame, table: str, schema: Sequence[Col] | None = None, fmt: str = "parquet", layout: Sequence[str] = ()) -> str:
    """Replace the rows of an existing table and keep its definition, by one change of its location.

    Columns are matched by name and cast to the table's types. The new version lies beside the old one; the
    table shows the old rows until the location changes. Returns the new location.
    """
    spark = df.sparkSession
    if schema is not None:
        df = conform(df, schema)
    df = conform(df, [Col(f.name, f.dataType.simpleString()) for f in spark.table(table).schema.fields])
    here = _location(spark, table)
    base = here.rpartition("/version-")[0] or here
    path = write_version(df, base, None, fmt, layout)
    spark.sql(f"ALTER TABLE {table} SET LOCATION '{path}'")
    spark.catalog.refreshTable(table)
    return path


# ----------------------------------------------------------------------------- stable keys
def with_registered_key(df: DataFrame, keys: Sequence[str], registry: str, name: str = "surrogate_id") -> DataFrame:
    """Prepend a BIGINT key that a business key keeps through all refreshes.

    ``registry`` is a published mart (see above) of (keys, name). Business keys that it does not hold get
    the numbers above its high-water mark, in key order; numbers of keys that are no longer delivered stay
    reserved. NULL is a key value like others. The extended registry is published before the result is
    returned, so no number is given twice; a run that fails before leaves registry and numbers as they were.

    The old registry is joined on the keys; only unseen keys are sorted, in ranges numbered by partition
    offsets. Runs that extend one registry must not overlap.
    """
    from martforge.sources.sinks import with_surrogate_key

    spark, base = df.sparkSession, registry.rstrip("/")
    keys = list(keys)
    now = df.select(*keys).distinct()
    if published_version(spark, base) is None:
        known = spark.createDataFrame([], now.schema).select(F.lit(0).cast("long").alias(name), *keys)
    else:
        known = read_published(spark, base).select(name, *keys)
    same = [F.col(f"n.{k}").eqNullSafe(F.col(f"o.{k}")) for k in keys]
    fresh = now.alias("n").join(known.alias("o"), same, "left_anti")
    top = known.agg(F.coalesce(F.max(name), F.lit(0))).first()[0]
    numbered = with_surrogate_key(fresh, keys, name, "dense").withColumn(name, F.col(name) + F.lit(top))
    refresh(known.unionByName(numbered), base)
    held = read_published(spark, base).alias("o")
    rows = df.alias("n")
    return rows.join(held, [F.col(f"n.{k}").eqNullSafe(F.col(f"o.{k}")) for k in keys]).select(F.col(f"o.{name}").alias(name), *[F.col(f"n.{c}").alias(c) for c in df.columns])


# ----------------------------------------------------------------------------- quarantine
def split_dirty(df: DataFrame, types: Mapping[str, str], keys: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Rows whose raw values fit the declared types, and the rejected rows with their reasons.

    ``types`` maps columns to the types they must convert to. A value that is set but does not convert (or
    does not fit the type's range) rejects its row; NULL and blank values are unset and become NULL. Returns
    (clean, rejected): ``clean`` has the columns of ``df`` with the declared types, ``rejected`` the ``keys``
    (all columns by default) as they came and ``reasons``, an array of (column, value, wanted). Every row is
    in exactly one of the two and no value aborts the job. Both are lazy: the test is part of whatever scan
    reads the clean rows.
    """
    def value(c: str) -> Column:
        raw = F.trim(F.col(c).cast("string"))
        return F.when(raw != "", raw)

    reasons = F.filter(F.array(*[
        F.when(value(c).isNotNull() & value(c).try_cast(t).isNull(),
               F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"), F.lit(t).alias("wanted")))
        for c, t in types.items()]), lambda r: r.isNotNull())
    marked = df.withColumn("_reasons", reasons)
    clean = marked.where(F.size("_reasons") == 0).select(*[value(c).try_cast(types[c]).alias(c) if c in types else F.col(c) for c in df.columns])
    rejected = marked.where(F.size("_reasons") > 0).select(*(keys or df.columns), F.col("_reasons").alias("reasons"))
    return clean, rejected


class CheckedSources(Sources):
    """Sources whose malformed values do not abort a mart: their rows go to a side table with the reason.

    ``types`` maps a table to the types of its columns. At the first use of a table its rejected rows are
    published at ``<rejects>/<TABLE>`` in one pass that reads the checked columns and ``keys`` only, and
    counted while it runs (``counts[TABLE]`` = rows seen, rows rejected); the mart reads the others.
    """

    def __init__(self, inner: Sources, types: Mapping[str, Mapping[str, str]], rejects: str, keys: Mapping[str, Sequence[str]] | None = None) -> None:
        self.spark, self.inner, self.rejects = inner.spark, inner, rejects.rstrip("/")
        self.types = {t.upper(): dict(c) for t, c in types.items()}
        self.keys = {t.upper(): list(k) for t, k in (keys or {}).items()}
        self.counts: dict[str, tuple[int, int]] = {}
        self._clean: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        name = name.upper()
        if name not in self.types:
            return self.inner.table(name)
        if name not in self._clean:
            df = self.inner.table(name)
            types = {c: t for c, t in self.types[name].items() if c in df.columns}
            clean, _ = split_dirty(df, types)
            read = df.select(*dict.fromkeys([*self.keys.get(name, df.columns), *types]))
            seen = Observation(f"quarantine of {name}")
            _, rejected = split_dirty(read.observe(seen, F.count(F.lit(1)).alias("rows")), types, self.keys.get(name, ()))
            bad = Observation(f"rejected of {name}")
            refresh(rejected.observe(bad, F.count(F.lit(1)).alias("rows")), f"{self.rejects}/{name}")
            self.counts[name] = (seen.get["rows"], bad.get["rows"])
            self._clean[name] = clean
        return self._clean[name]

    def rejected(self, name: str) -> DataFrame:
        """Rejected rows of a table: keys and reasons."""
        self.table(name)
        return read_published(self.spark, f"{self.rejects}/{name.upper()}")
