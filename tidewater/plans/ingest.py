"""Landing -> bronze in batch: typed CSV read, cleansing, rules, quarantine.

The landing files for the driver's tables are written by executors from
:func:`tidewater.sources.testmap.raw_text_lines` (one CSV file per task, with
the 53-column header), then read back exactly like production landing files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.clean import clean
from ..operators.rules import expect_or_drop, quarantine, rule_failure_counts
from ..schemas import CORRUPT_COL, RAW_HEADERS
from ..session import scratch_path
from ..sinks.tables import write_csv
from ..sources.landing import read_landing, read_landing_untyped
from ..sources.testmap import raw_text_lines


#: Lines of a landing file at most: a compressed file is read by one task.
LINES_PER_FILE = 200_000


def write_landing(spark: SparkSession, sf_dir: str, defects: bool = True,
                  encoding: str | None = None, name: str = "landing",
                  transform=None, files: int | None = None, lines_per_file: int = LINES_PER_FILE) -> str:
    """Write the tables' order lines as landing CSV files; returns the folder.

    ``files`` asks for a fixed number of plain files (a round-robin repartition of the text);
    by default each write task produces a gzip file for every ``lines_per_file`` lines.
    """
    lines = raw_text_lines(spark, sf_dir, defects)
    if transform is not None:
        lines = transform(lines)
    if files:
        lines = lines.repartition(files)
    path = scratch_path(spark, name)
    write_csv(lines.toDF(*RAW_HEADERS), path, header=True, encoding=encoding,
              lines_per_file=None if files else lines_per_file, gzip=not files)
    return path


def cleaned_lines(spark: SparkSession, path: str, encoding: str | None = None) -> DataFrame:
    """Typed + cleaned landing lines, with a ``malformed`` flag (rescue text dropped)."""
    df = clean(read_landing(spark, path, encoding))
    return (df.withColumn("malformed", F.col(CORRUPT_COL).isNotNull())
              .drop(CORRUPT_COL))


def bronze_batch(spark: SparkSession, path: str, encoding: str | None = None) -> DataFrame:
    """Lines that parse and pass every rule (the bronze table)."""
    return expect_or_drop(clean(read_landing(spark, path, encoding)))


def quarantine_batch(spark: SparkSession, path: str, encoding: str | None = None) -> DataFrame:
    """Rejected lines with the comma-joined names of what they failed and, where malformed, their raw text."""
    q = quarantine(clean(read_landing(spark, path, encoding)))
    return q.withColumn("failed_rules", F.array_join("failed_rules", ","))


def rule_metrics_batch(spark: SparkSession, path: str, encoding: str | None = None) -> DataFrame:
    return rule_failure_counts(clean(read_landing(spark, path, encoding)))


def untyped_lines(spark: SparkSession, path: str, encoding: str | None = None) -> DataFrame:
    return read_landing_untyped(spark, path, encoding)
