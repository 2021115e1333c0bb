"""Key lookups and distinct counts, expressed as joins and aggregates.

A membership filter whose list comes from data is a left-semi join here:
no key list is collected to the driver, so the filter side may be as large
as the data itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sinks.tables import materialize


def rows_of_keys(rows: DataFrame, keys_from: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``rows`` whose key appears in ``keys_from`` (left semi join).

    The distinct keys are stored first, so the join is planned with their size: ``rows`` are shuffled only where the keys
    are too many to broadcast.
    """
    wanted = materialize(rows.sparkSession, keys_from.select(*keys).distinct(), "wanted-keys")
    return rows.join(wanted, keys, "left_semi")


def distinct_count(df: DataFrame, cols: list[str], alias: str) -> DataFrame:
    """One row: number of distinct non-null tuples (partial aggregation per task)."""
    return df.agg(F.count_distinct(*[F.col(c) for c in cols]).alias(alias))


def distinct_rows(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.select(*cols).distinct()


def most_frequent_key(df: DataFrame, key: str) -> DataFrame:
    """One row: the key with the most rows (ties -> smallest key)."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    return counts.orderBy(F.col("_n").desc(), F.col(key).asc()).limit(1).select(key)
