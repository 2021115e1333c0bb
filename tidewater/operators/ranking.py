"""Exact ``ntile`` over a global order, without a single-partition window.

``ntile(k) OVER (ORDER BY ...)`` with no partition moves every row into one
task.  Two distributed forms, both equal to the built-in one for a total order:

``cuts`` (the default): of the n rows only the k - 1 sort tuples at the buckets'
last positions are needed, and a row's bucket is one more than the number of
those tuples below its own.  They are selected exactly: a sample gives 1,023
pivots, one pass counts the rows between pivots for all orders together, and the
few intervals that hold a wanted position are searched again until they are small
enough for one sort.  No row is shuffled and all columns are added in one pass.

``range``: the rows are stored once (the shuffle by ranges reads them twice), range-partitioned and sorted by the whole sort tuple,
numbered by their place in their range, and the ranges' counts (one row per
range, as many as the session's shuffle partitions) give the 0-based global
position ``g``.  With n rows, k buckets, q = n div k, r = n mod k:
``g < r(q+1) ? g div (q+1) + 1 : r + (g - r(q+1)) div q + 1``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (BooleanType, DataType, DateType, DecimalType, DoubleType, FloatType, IntegralType, StringType,
                               TimestampNTZType, TimestampType)

from ..sinks.tables import materialize


@dataclass(frozen=True)
class SortKey:
    column: str
    ascending: bool = True
    nulls_first: bool | None = None   # default: asc -> nulls first, desc -> nulls last

    @property
    def nf(self) -> bool:
        return self.ascending if self.nulls_first is None else self.nulls_first

    def expr(self) -> Column:
        c = F.col(self.column)
        if self.ascending:
            return c.asc_nulls_first() if self.nf else c.asc_nulls_last()
        return c.desc_nulls_first() if self.nf else c.desc_nulls_last()


def asc(c: str) -> SortKey:
    return SortKey(c, True, True)


def desc(c: str) -> SortKey:
    return SortKey(c, False, False)


def builtin_ntile(df: DataFrame, k: int, order: list[SortKey], name: str) -> DataFrame:
    return df.withColumn(name, F.ntile(k).over(Window.orderBy(*[s.expr() for s in order])))


#: Layout of monotonically_increasing_id: the partition above, the row in it below.
_ROW_BITS = 33


def range_ntile(df: DataFrame, k: int, order: list[SortKey], name: str, ranges: int | None = None) -> DataFrame:
    """Distributed exact ntile; ``ranges`` defaults to the session's shuffle partitions.

    The sorted ranges are stored once, so positions and counts read the same rows.
    """
    spark = df.sparkSession
    by = [s.expr() for s in order]
    n_ranges = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = materialize(spark, df.repartitionByRange(n_ranges, *by).sortWithinPartitions(*by)
                         .withColumn("_at", F.monotonically_increasing_id()), "ntile")
    rng, row = F.shiftright("_at", _ROW_BITS), F.col("_at").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    counts = placed.groupBy(rng.alias("_rng")).agg(F.count(F.lit(1)).alias("_cnt"))       # at most n_ranges rows
    before = Window.orderBy("_rng").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_rng", F.coalesce(F.sum("_cnt").over(before), F.lit(0)).alias("_off"),
                            F.sum("_cnt").over(Window.partitionBy()).alias("_n"))
    j = placed.withColumn("_rng", rng).join(F.broadcast(offsets), "_rng")
    g, nn = F.col("_off") + row, F.col("_n")
    q = F.floor(nn / k)
    r = nn - q * k
    big = r * (q + 1)
    bucket = F.when(g < big, F.floor(g / (q + 1)) + 1).otherwise(
        r + F.floor((g - big) / F.greatest(q, F.lit(1))) + 1)
    return j.withColumn(name, bucket.cast("int")).drop("_rng", "_at", "_off", "_n")


#: Rows that one task may sort to find a tuple; pivots of a pass (one less than a power of two) and sampled rows for each.
SORTED_AT_ONCE, _STEPS, _SAMPLED = 100_000, 10, 32


def _reversed(c: Column, kind: DataType) -> list[Column]:
    """Columns whose ascending order is the descending order of ``c``."""
    if isinstance(kind, (IntegralType, BooleanType)):
        return [~c if isinstance(kind, BooleanType) else F.bitwise_not(c)]
    if isinstance(kind, DecimalType):
        return [-c]
    if isinstance(kind, (FloatType, DoubleType)):
        return [~F.isnan(c), -c]                       # NaN is the greatest value
    if isinstance(kind, StringType):                   # '~' is above every digit, so a longer text comes first
        return [F.concat(F.translate(F.hex(c), "0123456789ABCDEF", "FEDCBA9876543210"), F.lit("~"))]
    if isinstance(kind, DateType):
        return [-F.datediff(c, F.lit("1970-01-01").cast("date"))]
    if isinstance(kind, TimestampType):
        return [-F.unix_micros(c)]
    if isinstance(kind, TimestampNTZType):
        return [*_reversed(c.cast("date"), DateType()), *_reversed(F.date_format(c, "HH:mm:ss.SSSSSS"), StringType())]
    raise TypeError(f"no descending order for {kind.simpleString()}")


def sort_tuple(df: DataFrame, order: list[SortKey]) -> Column:
    """A struct whose natural order (ascending, nulls first) is ``order``."""
    out: list[Column] = []
    for s in order:
        c, kind = F.col(s.column), df.schema[s.column].dataType
        if not s.nf:
            out.append(c.isNull())
        elif not s.ascending:
            out.append(c.isNotNull())
        out += [c] if s.ascending else _reversed(c, kind)
    return F.struct(*[x.alias(f"c{i}") for i, x in enumerate(out)])


def _bucket_ends(n: int, k: int) -> list[int]:
    """1-based position of the last row of each bucket but the last one."""
    return sorted({min(n, i * (n // k) + min(i, n % k)) for i in range(1, k)} - {0})


def _sorted_list(rows: DataFrame, name: str) -> DataFrame:
    return rows.agg(F.sort_array(F.collect_list("e")).alias(name))


def _small(rows: DataFrame, wanted: dict[int, list[int]]) -> DataFrame:
    """Tuples (e) at the wanted places of each group (b, e); a group is sorted by one task."""
    place = F.row_number().over(Window.partitionBy("b").orderBy("e"))
    hit = F.lit(False)
    for b, places in wanted.items():
        hit = hit | ((F.col("b") == b) & F.col("at").isin(places))
    return rows.withColumn("at", place).where(hit).select("e")


def _evenly(every: Column, size: int) -> Column:
    """``size`` - 1 pivots, always, evenly spread over a sorted sample."""
    return F.transform(F.sequence(F.lit(1), F.lit(size - 1)), lambda i: F.get(every, F.floor(i * F.size(every) / size).cast("int")))


def _located(c: Column, pivots: Column) -> Column:
    """Number of pivots below ``c``: a binary search as one fold, so that its size does not grow with the steps wherever
    the optimizer repeats it (a chain of columns, each naming the one before three times, doubles at every push-down)."""
    steps = F.array(*[F.lit(2 ** step) for step in range(_STEPS - 1, -1, -1)])
    return F.aggregate(steps, F.lit(0), lambda b, step: F.when(c > F.get(pivots, b + step - 1), b + step).otherwise(b))


def select_tuples(tuples: DataFrame, n: int, positions: dict[str, list[int]], name: str = "cuts") -> dict[str, DataFrame]:
    """For each struct column of ``tuples`` the tuples at its 1-based ``positions``, as a table of one row with one sorted array.

    The rows of a column must differ.  The number of passes is about log(n / SORTED_AT_ONCE) / log(1,024).
    """
    if n <= SORTED_AT_ONCE:
        return {c: _sorted_list(_small(tuples.select(F.lit(0).alias("b"), F.col(c).alias("e")), {0: at}), c) for c, at in positions.items()}
    spark, size = tuples.sparkSession, 2 ** _STEPS
    # stored: one row with the sorted sample of each column, so no plan repeats the sort
    drawn = materialize(spark, tuples.sample(min(1.0, size * _SAMPLED / n), seed=7).agg(
        *[F.sort_array(F.collect_list(c)).alias(c) for c in positions]), f"{name}-sample")
    pivots = drawn.select(*[_evenly(F.col(c), size).alias(f"p_{c}") for c in positions])
    located = tuples.crossJoin(F.broadcast(pivots)).select(                                           # one row
        *positions, *[_located(F.col(c), F.col(f"p_{c}")).alias(f"b_{c}") for c in positions])
    found = (located.select(F.posexplode(F.array(*[f"b_{c}" for c in positions])).alias("s", "b")).groupBy("s", "b").count()
             .collect())                                                                              # at most 1,024 rows a column
    out = {}
    for s, (c, places) in enumerate(positions.items()):
        counts = {r["b"]: r["count"] for r in found if r["s"] == s}
        wanted: dict[int, list[int]] = {}
        before, todo = 0, list(places)
        for b in sorted(counts):
            while todo and todo[0] <= before + counts[b]:
                wanted.setdefault(b, []).append(todo.pop(0) - before)
            before += counts[b]
        near = located.where(F.col(f"b_{c}").isin(list(wanted))).select(F.col(f"b_{c}").alias("b"), F.col(c).alias("e"))
        small = {b: p for b, p in wanted.items() if counts[b] <= SORTED_AT_ONCE}
        parts = [_small(near.where(F.col("b").isin(list(small))), small)] if small else []
        for b in wanted.keys() - small.keys():
            inner = materialize(spark, near.where(F.col("b") == b).select("e"), f"{name}-part")
            parts.append(select_tuples(inner, counts[b], {"e": wanted[b]}, name)["e"].select(F.explode("e").alias("e")))
        rows = parts[0]
        for p in parts[1:]:
            rows = rows.unionByName(p)
        out[c] = _sorted_list(rows, c)
    return out


def cut_ntiles(df: DataFrame, specs: list[tuple[str, int, list[SortKey]]], stored: bool = False) -> DataFrame:
    """Add an ntile column for each (name, k, order).

    ``stored``: ``df`` is cheap to read several times, gives the same rows each time, and no two rows agree in a
    whole sort tuple.  Otherwise it is stored once and the place of a row there ends every sort tuple.
    """
    if not stored:
        df = materialize(df.sparkSession, df.withColumn("_row", F.monotonically_increasing_id()), "ntile")
        specs = [(name, k, [*order, asc("_row")]) for name, k, order in specs]
    n = df.count()
    tuples = df.select(*[sort_tuple(df, order).alias(f"e{i}") for i, (_, _, order) in enumerate(specs)])
    ends = {f"e{i}": _bucket_ends(n, k) for i, (_, k, _) in enumerate(specs)}
    cuts = select_tuples(tuples, n, {c: p for c, p in ends.items() if p})
    out = df
    for i, (name, _, order) in enumerate(specs):
        if f"e{i}" not in cuts:
            out = out.withColumn(name, F.lit(1).cast("int"))
            continue
        own = sort_tuple(df, order)
        below = F.size(F.filter(f"_cuts{i}", lambda x: x < own))                                      # at most k - 1 cuts
        out = out.crossJoin(F.broadcast(cuts[f"e{i}"].withColumnRenamed(f"e{i}", f"_cuts{i}"))).withColumn(name, (below + 1).cast("int"))
    return out.drop("_row", *[f"_cuts{i}" for i in range(len(specs))])


def ntile_columns(df: DataFrame, specs: list[tuple[str, int, list[SortKey]]], method: str = "cuts",
                  ranges: int | None = None, stored: bool = False) -> DataFrame:
    """Add one ntile column per (name, k, order) spec.

    ``method``: ``cuts`` (selected boundaries, see :func:`cut_ntiles`), ``range`` (distributed sort) or ``builtin``
    (the single-partition window, for comparison).
    """
    if method == "cuts":
        return cut_ntiles(df, specs, stored)
    if method == "range" and not stored:              # a range shuffle reads its input twice: first a sample for the borders
        df = materialize(df.sparkSession, df, "ntile-input")
    for name, k, order in specs:
        df = builtin_ntile(df, k, order, name) if method == "builtin" else range_ntile(df, k, order, name, ranges)
    return df
