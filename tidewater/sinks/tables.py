"""Table sinks: parquet at rest, written by executors."""

from __future__ import annotations

import time
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession

from ..session import children, delete_path, scratch_path, shuffles_removed

#: Codec of tables that the library reads again itself.
CODEC = "zstd"


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None,
                mode: str = "overwrite", compression: str | None = None) -> str:
    """Fully recomputed table: overwrite (dynamic per partition when partitioned)."""
    w = df.write.mode(mode)
    if compression:
        w = w.option("compression", compression)
    if partition_by:
        w = w.partitionBy(*partition_by)
    with shuffles_removed(df.sparkSession):
        w.parquet(path)
    return path


def materialize(spark: SparkSession, df: DataFrame, name: str,
                partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` as parquet under the shared folder and read it back.

    Cuts the lineage (a lost executor re-reads files instead of recomputing
    joins) while keeping column pruning and filter pushdown for readers,
    which an RDD checkpoint would not.
    """
    path = scratch_path(spark, name)
    write_table(df, path, partition_by, compression=CODEC)
    return spark.read.parquet(path)


def file_slices(table: DataFrame, rows_at_once: int) -> list[DataFrame]:
    """A stored table as several of whole files each, with about ``rows_at_once`` rows (the count comes from the footers).

    What is computed row by row can so be stored slice by slice: only one slice's shuffle files exist at a time.
    """
    files, n = sorted(table.inputFiles()), -(-table.count() // rows_at_once)
    if n <= 1 or len(files) <= 1:
        return [table]
    read = table.sparkSession.read.schema(table.schema)
    return [read.parquet(*[unquote(f) for f in files[i::n]]) for i in range(min(n, len(files)))]


def materialize_slices(spark: SparkSession, slices: list[DataFrame], name: str) -> DataFrame:
    """All ``slices`` stored in one table, one after the other."""
    path = scratch_path(spark, name)
    for part in slices:
        write_table(part, path, mode="append", compression=CODEC)
    return spark.read.parquet(path)


def write_keyed(df: DataFrame, path: str, key: str, partitions: int | None = None) -> str:
    """Table for lookups by ``key``: rows in key order over the files, Bloom filters of the key.

    An equality on the key then opens the few row groups whose statistics and filter admit it.  Sorted ranges are
    split by key alone, so all rows of one key lie in one file (a hot key in one task).
    """
    n = [partitions] if partitions else []
    with shuffles_removed(df.sparkSession):
        (df.repartitionByRange(*n, key).sortWithinPartitions(key).write.mode("overwrite")
           .option(f"parquet.bloom.filter.enabled#{key}", "true").parquet(path))
    return path


def write_csv(df: DataFrame, path: str, header: bool = True, encoding: str | None = None,
              mode: str = "overwrite", lines_per_file: int | None = None, gzip: bool = False) -> str:
    """Landing-style CSV files with a header row (one file per task, or more of at most ``lines_per_file`` lines)."""
    w = df.write.mode(mode).option("header", header)
    if encoding:
        w = w.option("encoding", encoding)
    if lines_per_file:
        w = w.option("maxRecordsPerFile", lines_per_file)
    if gzip:
        w = w.option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED")
    with shuffles_removed(df.sparkSession):
        w.csv(path)
    return path


def publish_table(df: DataFrame | list[DataFrame], path: str, kept: int = 2) -> str:
    """Fully recomputed table as a new version folder below ``path``.

    Readers see a version only once Spark has committed it, so never a half
    written table; the newest ``kept`` versions stay for readers still at work.
    A list of slices is written one after the other; the last one completes the version.
    """
    parts = df if isinstance(df, list) else [df]
    spark = parts[0].sparkSession
    done = _versions(spark, path)
    number = max(int(time.time() * 1000), int(done[-1][2:]) + 1 if done else 0)
    for i, part in enumerate(parts, 1):
        w = part.write.mode("append" if i > 1 else "errorifexists").option("compression", CODEC)
        with shuffles_removed(spark):
            w.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", i == len(parts)).parquet(f"{path}/v={number:015d}")
    for name in _versions(spark, path)[:-kept]:
        delete_path(spark, f"{path}/{name}")
    return path


def _versions(spark: SparkSession, path: str) -> list[str]:
    return [n for n in children(spark, path) if n.startswith("v=") and "_SUCCESS" in children(spark, f"{path}/{n}")]


def read_published(spark: SparkSession, path: str) -> DataFrame:
    """The newest committed version of a published table."""
    done = _versions(spark, path)
    if not done:
        raise FileNotFoundError(f"no published version below {path}")
    return spark.read.parquet(f"{path}/{done[-1]}")
