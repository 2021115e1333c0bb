"""Session construction and shared-storage helpers.

Everything that must survive an executor loss (checkpoints, scratch tables,
stream state) lives under the folder the cluster names in
``spark.checkpoint.dir``.  Only when that setting is absent (local tests) do
we pick a private folder under the system temp dir.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

#: Rows that a task of a shuffle should hold at most (a few hundred bytes each in a sort).
ROWS_OF_A_TASK = 1_000_000
_FIRST_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
_METHOD_LIMIT = "spark.sql.codegen.hugeMethodLimit"
_SHUFFLE_REMOVAL = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # the JVM never compiles methods above 8,000 bytes of code; wider generated ones (53 typed landing columns) run in split form
    _METHOD_LIMIT: "8000",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "tidewater", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    shared_dir(spark)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Root of the shared (cluster-visible) working folder.

    Reads ``spark.checkpoint.dir`` from the session.  Only a local session may
    go without it (tests): it gets a private folder; a cluster session fails.
    Also points the SparkContext checkpoint dir at it so that
    ``DataFrame.checkpoint()`` writes there.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="tidewater-")
        spark.conf.set("spark.checkpoint.dir", root)
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    compilable_methods(spark)
    return root


def compilable_methods(spark: SparkSession) -> None:
    """Wide projections run in split form also in a session that ``build_session`` did not make; a lower limit stays."""
    if int(spark.conf.get(_METHOD_LIMIT)) > int(DEFAULT_CONF[_METHOD_LIMIT]):
        spark.conf.set(_METHOD_LIMIT, DEFAULT_CONF[_METHOD_LIMIT])


def tasks_for(rows: int) -> int:
    return -(-rows // ROWS_OF_A_TASK)


def room_for(spark: SparkSession, rows: int) -> None:
    """Lets joins of ``rows`` rows start with more partitions than the session's, where a task would get too many of
    them; the adaptive planner puts small ones together again.  A higher number stays."""
    own = spark.conf.get(_FIRST_PARTITIONS, None) or spark.conf.get("spark.sql.shuffle.partitions")
    if tasks_for(rows) > int(own):
        spark.conf.set(_FIRST_PARTITIONS, str(tasks_for(rows)))


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """A write that is run inside removes its shuffle files as soon as it has ended; otherwise they stay until the driver's
    garbage collector happens to find them, and the next steps' files come on top."""
    before = spark.conf.get(_SHUFFLE_REMOVAL)
    spark.conf.set(_SHUFFLE_REMOVAL, "true")
    try:
        yield
    finally:
        spark.conf.set(_SHUFFLE_REMOVAL, before)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never-reused path under the shared folder."""
    root = shared_dir(spark).rstrip("/")
    return f"{root}/tidewater/{name}-{uuid.uuid4().hex[:12]}"


def table_path(sf_dir: str, table: str) -> str:
    return os.path.join(sf_dir, f"{table}.parquet")


def _file_system(spark: SparkSession, path: str):
    """(the store's file system, the path) as Spark sees them: works for every scheme."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()), jvm_path


def children(spark: SparkSession, path: str) -> list[str]:
    """Sorted names below a folder of any store; empty if it doesn't exist, other errors are raised."""
    fs, p = _file_system(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def delete_path(spark: SparkSession, path: str) -> None:
    fs, p = _file_system(spark, path)
    fs.delete(p, True)


def folder_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of all files below a folder of any store."""
    fs, p = _file_system(spark, path)
    return fs.getContentSummary(p).getLength()
