"""Helpers shared by the training-data operators."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.session import scratch_path, table_path

#: A word is a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def save(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` below the shared folder and read it back.

    The stored table cuts the lineage: an executor lost later costs a re-read,
    not a recomputation, and non-deterministic row ids become stable.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.schema(spark.read.parquet(path).schema).parquet(path)


def text_or_empty(col: str = "text"):
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def slices(batch: pa.RecordBatch, col: str, max_bytes: int = 1 << 20):
    """Cut a record batch so that each piece holds about ``max_bytes`` of ``col``.

    A single longer value forms a piece of its own; nothing is cut or dropped.
    """
    n = batch.num_rows
    if not n:
        return
    arr = batch.column(batch.schema.get_field_index(col))
    ends = np.cumsum(np.asarray(pa.compute.fill_null(pa.compute.binary_length(arr), 0), dtype=np.int64))
    lo = 0
    while lo < n:
        before = ends[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(ends, before + max_bytes, side="right")))
        yield batch.slice(lo, hi - lo)
        lo = hi


def list_offsets(counts: np.ndarray) -> np.ndarray:
    out = np.zeros(len(counts) + 1, dtype=np.int64)
    np.cumsum(counts, out=out[1:])
    return out


def located(docs: DataFrame) -> DataFrame:
    """``docs`` with the content locator (__tw_file, __tw_row): hash of the file path, row in the file.

    Rows that do not come straight from files are stored first.
    """
    def add(df):
        return df.select("*", F.xxhash64("_metadata.file_path").alias("__tw_file"), F.col("_metadata.row_index").alias("__tw_row"))

    try:
        return add(docs)
    except AnalysisException:
        return add(save(docs, "located-input"))


#: Bits of the filter that keeps rows without a partner out of shuffles: at most 2 MB are broadcast.
FILTER_BITS, _PER_ROW = 1 << 24, 1 << 15


def maybe_among(rows: DataFrame, hits: DataFrame, *key: str) -> DataFrame:
    """``rows`` with __tw_maybe: false only if the row's key is surely not among ``hits``.

    The keys set bits of a map of fixed size, whatever their number; with
    very many of them it says "maybe" more often, never wrongly "no".
    """
    bit = F.pmod(F.xxhash64(*key), F.lit(FILTER_BITS))
    number, at = F.floor(bit / _PER_ROW).cast("int"), (bit % _PER_ROW).cast("int")
    maps = (hits.select(number.alias("__tw_no"), at.cast("long").alias("at")).groupBy("__tw_no")
            .agg(F.bitmap_construct_agg("at").alias("__tw_map")))          # FILTER_BITS / _PER_ROW rows of 4 kB at most
    byte = F.conv(F.hex(F.substring(F.col("__tw_map"), F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return (rows.withColumn("__tw_no", number).join(F.broadcast(maps), "__tw_no", "left")
            .withColumn("__tw_maybe", F.coalesce(F.getbit(byte, at % 8) == 1, F.lit(False))).drop("__tw_no", "__tw_map"))


def without_rows(rows: DataFrame, dropped: DataFrame) -> DataFrame:
    """Located ``rows`` but for the locators of ``dropped``; few other rows are shuffled."""
    key = ["__tw_file", "__tw_row"]
    gone = save(dropped.select(*key), "dropped-rows")
    flagged = maybe_among(rows, gone, *key)
    checked = flagged.where("__tw_maybe").join(gone.hint("merge"), key, "left_anti")
    return flagged.where("not __tw_maybe").unionByName(checked.select(*flagged.columns)).drop("__tw_maybe")
