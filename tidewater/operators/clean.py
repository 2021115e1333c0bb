"""Bronze cleansing: column names, multi-format dates, 0/1 flags."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..functions.expressions import int_to_bool, parse_multi_ts
from ..schemas import BOOL_COLS, DATE_COLS, normalize_name


def normalize_columns(df: DataFrame) -> DataFrame:
    """Rename every column with :func:`normalize_name` (metadata only)."""
    return df.toDF(*[normalize_name(c) for c in df.columns])


def clean(df: DataFrame, date_cols=DATE_COLS, boolean_cols=BOOL_COLS) -> DataFrame:
    """Normalise names, parse dates, map 0/1 flags; cleaned columns move to the end.

    One ``select`` - a single projection that Catalyst fuses with the scan.
    """
    df = normalize_columns(df)
    moved = list(date_cols) + list(boolean_cols)
    keep = [c for c in df.columns if c not in moved]
    cleaned = ([parse_multi_ts(c).alias(c) for c in date_cols]
               + [int_to_bool(c).alias(c) for c in boolean_cols])
    return df.select(*[df[c] for c in keep], *cleaned)
