"""Session helpers: a local session for tests/bench and a shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager
from typing import Iterator

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "sectionmap") -> SparkSession:
    """A local session configured the way the tests and the bench expect.

    On a cluster the session comes from the platform; nothing here is required
    by the library itself.
    """
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        # Checkpoint files of DataFrames the driver no longer references are deleted.
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_base(spark: SparkSession) -> str:
    """The shared folder for checkpoints and scratch tables.

    ``spark.checkpoint.dir`` is a static setting: on a cluster it names storage
    every executor can reach, and it is only read here.  When it is absent (a
    local test session) a local folder is registered with the SparkContext
    instead; on any other master a missing setting is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base
    ctx = spark.sparkContext.getCheckpointDir()
    if ctx:
        return ctx
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    base = tempfile.mkdtemp(prefix="sectionmap-ckpt-")
    spark.sparkContext.setCheckpointDir(base)
    return spark.sparkContext.getCheckpointDir() or base


#: The scratch folders of each open scope, innermost last.
_scopes: list[list[str]] = []


def scratch_dir(spark: SparkSession, name: str = "work") -> str:
    """A fresh, uniquely named folder under the shared checkpoint folder."""
    path = os.path.join(checkpoint_base(spark), f"{name}-{uuid.uuid4().hex[:12]}")
    if _scopes:
        _scopes[-1].append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Remove the scratch folders made inside the block when it ends: what was built from
    them must be written by then."""
    _scopes.append([])
    try:
        yield
    finally:
        for path in _scopes.pop():
            p = spark._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


#: Spark removes shuffle files when the driver's garbage collector finds them unused, which may be after the query.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Remove the shuffle files of each write inside the block as soon as it has ended."""
    old = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, old)


def staged(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Write ``df`` once as Parquet under the shared folder (at ``path``, when it must outlive
    the scope it is built in) and read it back.

    Lineage ends at the table, and unlike a checkpoint of whole rows the later
    readers scan only the columns they use, with filters pushed down and sizes
    known to the optimizer."""
    path = path or scratch_dir(df.sparkSession, name)
    with shuffles_removed(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def tasks_for(rows: DataFrame, each: int) -> int:
    """Tasks so that one holds about ``each`` rows, the session's number at least: what a
    task sorts stays as it is when the input grows."""
    return max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows.count() // each))
