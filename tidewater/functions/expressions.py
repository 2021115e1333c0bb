"""Column expressions used by the cleansing and analytic layers.

All of these are built-in Spark expressions, so they stay inside whole-stage
codegen; nothing here ships rows to Python.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted landing date formats, tried in this order.
DATE_FORMATS = ["M/d/yyyy H:mm", "M/d/yyyy HH:mm", "dd-MM-yyyy HH:mm"]

# Fixed value: kilometres per mile.
KM_PER_MILE = 1.60934


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


_EPOCH_NTZ = "1970-01-01 00:00:00"


def parse_multi_ts(c, formats=DATE_FORMATS) -> Column:
    """First format that parses wins; text that fits none becomes null.

    ``try_to_timestamp`` keeps ANSI mode from failing the whole job on the
    first non-matching format.  The text is read as UTC (explicit offset) and
    turned back into a wall-clock ``timestamp_ntz`` through epoch seconds, so
    the result does not depend on the session time zone (no DST gaps).
    """
    text = _c(c)
    col = F.concat(text, F.lit(" +0000"))
    parse = lambda fs: F.coalesce(*[F.try_to_timestamp(col, F.lit(f + " Z")) for f in fs])
    # a one-digit pattern also reads two digits, so "HH" after "H" adds nothing; the separator picks the rest
    lean = [f for f in formats if f.replace("HH", "H") == f or f.replace("HH", "H") not in formats]
    slashed, other = [f for f in lean if "/" in f], [f for f in lean if "/" not in f]
    if not (slashed and other):
        return utc_wall_clock(parse(lean))
    return utc_wall_clock(F.when(F.contains(text, F.lit("/")), parse(slashed)).otherwise(parse(other)))


def utc_wall_clock(instant) -> Column:
    """Instant (``timestamp``) -> UTC wall clock (``timestamp_ntz``), whatever the session zone."""
    secs = (F.unix_micros(_c(instant)) / F.lit(1_000_000)).cast("decimal(18,6)")
    return F.lit(_EPOCH_NTZ).cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), secs)


def int_to_bool(c) -> Column:
    """1 -> true, 0 -> false, anything else (incl. null) -> null."""
    col = _c(c)
    return F.when(col == 1, F.lit(True)).when(col == 0, F.lit(False)).otherwise(F.lit(None).cast("boolean"))


def miles_to_km(c) -> Column:
    """Distance in miles -> kilometres as a float; null stays null."""
    return (_c(c) * F.lit(KM_PER_MILE)).cast("float")


def guarded_ratio(num, den) -> Column:
    """num / den when den > 0, else 0.0."""
    n, d = _c(num), _c(den)
    return F.when(d > 0, n / d).otherwise(F.lit(0.0))


def exact_avg(c) -> Column:
    """Average as exact-sum / count, cast to double.

    For decimals the sum is exact, so the result does not depend on how
    partial sums were combined; for integers likewise.
    """
    col = _c(c)
    return F.sum(col).cast("double") / F.count(col).cast("double")


def money_sum(c) -> Column:
    """Exact decimal sum presented as a double."""
    return F.sum(_c(c)).cast("double")
