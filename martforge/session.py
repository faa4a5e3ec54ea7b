"""Session helpers: a tuned local session for tests/bench and checkpoint-dir resolution."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "martforge") -> SparkSession:
    """Session used by tests and bench; a cluster deployment passes its own session."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.codegen.cache.maxEntries", "2000")
        .getOrCreate()
    )


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and scratch tables.

    Taken from the session (``spark.checkpoint.dir`` or the context's checkpoint dir).
    Only a local-mode session without one gets a fresh temporary folder; on a cluster a
    machine-local folder would lose data with its executor, so the setting is required.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="martforge-ckpt-"))
    return sc.getCheckpointDir()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per context (what ``--py-files`` does)."""
    sc = spark.sparkContext
    if getattr(sc, "_martforge_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="martforge-py-"), "martforge_src.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(archive)
    sc._martforge_shipped = True


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written as Parquet into the shared folder and read back: cuts the lineage, survives lost
    executors, is computed once and prunes columns for its readers."""
    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[str]:
    """Checkpoints and stored tables made inside go to a folder of their own, which is removed at the end."""
    sc, outer = spark.sparkContext, checkpoint_dir(spark)
    path_of = sc._jvm.org.apache.hadoop.fs.Path
    own = f"{outer.rstrip('/')}/scratch-{uuid.uuid4().hex}"
    sc.setCheckpointDir(own)
    try:
        yield own
    finally:
        path_of(own).getFileSystem(sc._jsc.hadoopConfiguration()).delete(path_of(own), True)
        sc.setCheckpointDir(path_of(outer).getParent().toString())
