"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from martforge.session import checkpoint_dir

#: A word: a maximal run of characters other than space and U+0009 to U+000D.
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Number of words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def shared_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder that the session names."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back: cuts the lineage, survives lost executors."""
    path = shared_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


def release(*tables: DataFrame) -> None:
    """Delete tables written by :func:`stored` whose successors are written; nothing lazy may still read them."""
    for df in tables:
        sc = df.sparkSession.sparkContext
        path = sc._jvm.org.apache.hadoop.fs.Path(df._stored_at)
        path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


#: Rows carry whole texts: a batch of so many stays at a few MB in the JVM and in the worker.
ARROW_ROWS = 512


def ship(spark: SparkSession) -> None:
    """Ready the session for tasks in Python: small Arrow batches, and this package sent to the workers
    once per context (what ``--py-files`` does)."""
    size = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(size)) <= ARROW_ROWS:
        spark.conf.set(size, str(ARROW_ROWS))
    sc = spark.sparkContext
    if getattr(sc, "_martforge_shipped", False):
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = os.path.join(tempfile.mkdtemp(prefix="martforge-py-"), "martforge_src.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(archive)
    sc._martforge_shipped = True


def ranked(df: DataFrame, group: list[str], cell: list[str], order: list[str], name: str) -> DataFrame:
    """Add ``name``: the 0-based rank of a row within ``group`` under (``cell``, ``order``).

    No task holds a group. Rows are counted per cell (with map-side partial sums), the counts
    are summed up over the cells of a group, and rows are numbered within their cell. ``group``
    and ``cell`` columns must not be null; ``cell`` must spread a group evenly (a hash, say) over
    a bounded number of values, since the cells of a group meet in one window.
    """
    before = Window.partitionBy(*group).orderBy(*cell).rowsBetween(Window.unboundedPreceding, -1)
    starts = (df.groupBy(*group, *cell).agg(F.count(F.lit(1)).alias("_n"))
              .withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n"))
    inside = Window.partitionBy(*group, *cell).orderBy(*order)
    return (df.join(starts, [*group, *cell])
            .withColumn(name, F.col("_before") + F.row_number().over(inside) - 1).drop("_before"))


def small_side(df: DataFrame, row_bytes: int, limit_mb: int = 32) -> DataFrame:
    """``df`` marked for broadcast if its counted rows of about ``row_bytes`` stay below ``limit_mb``, else as it is."""
    return F.broadcast(df) if df.count() * row_bytes <= limit_mb << 20 else df


def grouped_rows(batches, n_keys: int):
    """Groups of sorted Arrow batches: yields tables of consecutive rows with equal first ``n_keys`` columns."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    held: list = []

    def same(a, b) -> bool:
        return all(a.column(i)[a.num_rows - 1].as_py() == b.column(i)[0].as_py() for i in range(n_keys))

    for batch in batches:
        if not batch.num_rows:
            continue
        if held and not same(held[-1], batch):
            yield pa.Table.from_batches(held)
            held = []
        change = np.zeros(batch.num_rows - 1, bool)
        for i in range(n_keys):
            c = batch.column(i)
            change |= pc.not_equal(c.slice(1), c.slice(0, batch.num_rows - 1)).to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(change) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            part = batch.slice(a, b - a)
            if b < batch.num_rows:
                yield pa.Table.from_batches([*held, part])
                held = []
            else:
                held.append(part)
    if held:
        yield pa.Table.from_batches(held)
