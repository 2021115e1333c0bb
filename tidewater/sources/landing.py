"""Landing-zone CSV readers (batch and streaming).

Lines are read as text and typed afterwards, and whether a line fits the schema
is computed from the whole line: a wrong number of fields, or text in any typed
column that does not cast.  The flag is an expression over all typed columns,
so it does not depend on which columns a query selects.  Every file's header is
compared with the schema; a file with other or reordered columns stops the read
instead of being bound by position.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..functions.expressions import utc_wall_clock
from ..schemas import CORRUPT_COL, RAW_COLUMNS, normalize_name, raw_text_schema


def _csv_options(reader, encoding: str | None, checked: bool):
    reader = reader.option("header", True)
    if encoding:
        reader = reader.option("encoding", encoding)
    if checked:
        reader = (reader.option("mode", "PERMISSIVE")
                        .option("columnNameOfCorruptRecord", CORRUPT_COL)
                        .option("columnPruning", False)       # the number of fields is checked on whole lines
                        .option("enforceSchema", False))      # the header must be the schema's
    return reader


def _typed(text: DataFrame, *extra) -> DataFrame:
    """Typed columns with normalised names; the rescue column holds the raw text of lines that do not fit."""
    bad, cols = F.col(CORRUPT_COL).isNotNull(), []
    for name, kind in RAW_COLUMNS:
        c = F.col(f"`{name}`")
        if isinstance(kind, StringType):
            cols.append(c.alias(normalize_name(name)))
        else:
            value = c.try_cast(kind)
            bad = bad | (value.isNull() & c.isNotNull() & (F.trim(c) != ""))       # the text is looked at only where the cast fails
            cols.append(value.alias(normalize_name(name)))
    line = F.coalesce(F.col(CORRUPT_COL), F.to_csv(F.struct(*[F.col(f"`{n}`") for n, _ in RAW_COLUMNS])))
    return text.select(*cols, F.when(bad, line).alias(CORRUPT_COL), *extra)


def read_landing(spark: SparkSession, path: str, encoding: str | None = None) -> DataFrame:
    """Typed batch read with normalised column names and the rescue column."""
    return _typed(_csv_options(spark.read, encoding, True).schema(raw_text_schema()).csv(path))


def read_landing_untyped(spark: SparkSession, path: str, encoding: str | None = None) -> DataFrame:
    """Header-named, all-string batch read (for exploration)."""
    return _csv_options(spark.read, encoding, False).csv(path)


def stream_landing(spark: SparkSession, path: str, encoding: str | None = None,
                   max_files_per_trigger: int | None = None, max_bytes_per_trigger: str | None = None,
                   archive_dir: str | None = None) -> DataFrame:
    """Incremental file discovery over the landing folder.

    A micro-batch takes at most so many files, or so many bytes of them.  With ``archive_dir`` files are moved there
    after their batch; the folder must not lie below the landing folder.

    Adds ``ingested_at`` = the file's modification time (UTC wall clock):
    distinct per file inside one micro-batch, so it orders changes by arrival.
    """
    r = _csv_options(spark.readStream, encoding, True).schema(raw_text_schema())
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    if max_bytes_per_trigger:
        r = r.option("maxBytesPerTrigger", max_bytes_per_trigger)
    if archive_dir:
        r = r.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    return _typed(r.csv(path), utc_wall_clock(F.col("_metadata.file_modification_time")).alias("ingested_at"))
