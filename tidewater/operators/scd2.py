"""Change history, slowly changing dimension type 2, as a batch Spark job.

Definition (the result depends only on the *set* of change rows, never on
their arrival order or on how they were batched):

1. Rows with equal (key, sequence) collapse to one: the greatest by the
   tie-break columns (default: tracked columns, then the other columns).
2. Ordered by sequence within a key, a row opens a version when it is the
   key's first row or a tracked column differs (null-safe) from the row
   before it.
3. ``__START_AT`` = sequence of the opening row, ``__END_AT`` = start of the
   key's next version (null for the open version).
4. Untracked columns take the value of the last row inside the version.

Distribution: a segmented scan.  A key's rows form one segment, and a key with
more than its share of the rows is cut into several along the sequence, at
quantiles of its own sequence values.  The input is read and shuffled once, by
(key, segment), sorted once, and turned into versions by three stacked window
operators with frames that only move forward, so the work is linear in a segment's
rows.  There are as many tasks as shuffle partitions, and more of them where one would
have to sort over ``ROWS_OF_A_TASK`` rows, so a task's memory does not grow with the
input.  Which keys are cut is found beforehand by a frequent-items sketch over
the keys alone; only the work depends on it, never the result.

Without such keys that is all.  With them the segments' versions are stored, and
what crosses a segment's border - its first and its last version, at most two rows a
segment, and there are about as many segments as shuffle partitions - is merged in
one small table: versions that continue over borders become one, and the last version
of a segment ends where the key's next one starts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, NumericType, TimestampNTZType, TimestampType

from ..schemas import SCD_END, SCD_START
from ..session import tasks_for
from ..sinks.tables import materialize

#: Keys followed by the frequent-items sketch: a key with 1/1000 of the rows is surely found.
_FOLLOWED = 4096


def default_segments(changes: DataFrame, n: int = 0) -> int:
    """The session's shuffle partitions, at least 16; more where a task would get over ``ROWS_OF_A_TASK`` of ``n`` rows."""
    return max(16, int(changes.sparkSession.conf.get("spark.sql.shuffle.partitions")), tasks_for(n))


def _ticks(df: DataFrame, seq: str) -> Column | None:
    """A number that grows with the sequence; None if the type has none."""
    kind, c = df.schema[seq].dataType, F.col(seq)
    if isinstance(kind, TimestampNTZType):             # wall-clock seconds, independent of the session time zone
        days = F.datediff(c.cast("date"), F.lit("1970-01-01").cast("date")).cast("double")
        return days * 86400 + F.hour(c) * 3600 + F.minute(c) * 60 + F.second(c)
    if isinstance(kind, TimestampType):
        return F.unix_micros(c).cast("double")
    if isinstance(kind, DateType):
        return F.datediff(c, F.lit("1970-01-01").cast("date")).cast("double")
    return c.cast("double") if isinstance(kind, NumericType) else None


def hot_key_cuts(changes: DataFrame, keys: list[str], seq: str, segments: int | None = None) -> dict[int, list[float]]:
    """Hash of each key with over 1/``segments`` of the rows -> where to cut its sequence (ticks, ascending)."""
    return _count_and_cuts(changes, keys, seq, segments)[1]


def _count_and_cuts(changes: DataFrame, keys: list[str], seq: str, segments: int | None) -> tuple[int, dict[int, list[float]]]:
    """The number of rows and what ``hot_key_cuts`` gives.

    Two reads of the key (and, for those keys, the sequence) alone; at most 4,096 hashes, and ``segments`` cuts of each
    that is hot, reach the driver.
    """
    ticks = _ticks(changes, seq)
    if ticks is None:
        return changes.count(), {}
    rows = changes.select(F.xxhash64(*keys).alias("_h"), ticks.alias("_x"))
    n, found = rows.agg(F.count(F.lit(1)), F.expr(f"approx_top_k(_h, {_FOLLOWED}, {_FOLLOWED})")).collect()[0]
    segments = segments or default_segments(changes, n)
    hot = [r["item"] for r in found or [] if r["count"] > n / segments and r["count"] > 1]
    if not hot:
        return n, {}
    steps = [i / segments for i in range(1, segments)]
    got = rows.where(F.col("_h").isin(hot)).groupBy("_h").agg(
        F.count(F.lit(1)).alias("c"), F.percentile_approx("_x", steps, 10 * segments).alias("q")).collect()
    out = {}
    for r in got:                                      # about one cut for every n / segments rows of the key
        pieces = max(2, -(-r["c"] * segments // n))
        out[r["_h"]] = sorted({r["q"][max(0, round(i * segments / pieces) - 1)] for i in range(1, pieces)})
    return n, out


def _segment(changes: DataFrame, keys: list[str], seq: str, cuts: dict[int, list[float]]) -> DataFrame:
    """``changes`` with ``_seg``: number of the key's cuts at or before the row; 0 for keys without cuts."""
    table = changes.sparkSession.createDataFrame([(h, c) for h, c in cuts.items()], "_h long, _cuts array<double>")
    at = F.size(F.filter("_cuts", lambda c: c <= _ticks(changes, seq)))
    return (changes.withColumn("_h", F.xxhash64(*keys)).join(F.broadcast(table), "_h", "left")     # at most one row a hot key
            .withColumn("_seg", F.coalesce(F.when(F.col("_cuts").isNotNull(), at), F.lit(0))).drop("_h", "_cuts"))


def _local_versions(rows: DataFrame, parts: list[str], seq: str, tracked: list[str], tiebreak: list[str]) -> DataFrame:
    """Versions of each segment (rows with equal ``parts``) as if it stood alone: the last row of each, with start, end
    and whether it is the segment's first or last.  The windows share one shuffle and one sort."""
    by_tie = Window.partitionBy(*parts).orderBy(seq, *tiebreak)
    by_seq = Window.partitionBy(*parts).orderBy(seq)
    one = rows.withColumn("_next", F.lead(seq).over(by_tie)).where(~F.col("_next").eqNullSafe(F.col(seq))).drop("_next")
    t = F.struct(*tracked)
    opened = one.withColumn("_before", F.lag(seq).over(by_seq)).withColumn(
        "_open", F.col("_before").isNull() | ~t.eqNullSafe(F.lag(t).over(by_seq)))
    start = F.last(F.when(F.col("_open"), F.col(seq)), ignorenulls=True).over(by_seq.rowsBetween(Window.unboundedPreceding, 0))
    head = F.last(F.when(F.col("_before").isNull(), F.col(seq)), ignorenulls=True).over(by_seq.rowsBetween(Window.unboundedPreceding, 0))
    full = (opened.withColumn("_next_open", F.lead("_open").over(by_seq)).withColumn(SCD_END, F.lead(seq).over(by_seq))
            .withColumn(SCD_START, start).withColumn("_head", head))
    return (full.where(F.col("_next_open").isNull() | F.col("_next_open"))
            .withColumn("_first", F.col(SCD_START) == F.col("_head")).withColumn("_last", F.col("_next_open").isNull())
            .drop("_before", "_open", "_next_open", "_head"))


def _merge_borders(edges: DataFrame, keys: list[str], tracked: list[str], payload: list[str]) -> DataFrame:
    """First and last versions of the segments of cut keys, merged across borders."""
    order = Window.partitionBy(*keys).orderBy("_seg", SCD_START)
    t = F.struct(*tracked)
    goes_on = F.col("_first") & F.coalesce(F.lag("_last").over(order), F.lit(False)) & t.eqNullSafe(F.lag(t).over(order))
    grouped = edges.withColumn("_new", F.when(goes_on, 0).otherwise(1)).withColumn(
        "_group", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    at = F.struct("_seg", SCD_START)
    merged = grouped.groupBy(*keys, "_group").agg(
        F.min(SCD_START).alias("_start"), F.max_by(F.struct(*payload), at).alias("_row"), F.max_by(SCD_END, at).alias("_own_end"))
    by_group = Window.partitionBy(*keys).orderBy("_group")
    return merged.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in payload], F.col("_start").alias(SCD_START),
                         F.coalesce("_own_end", F.lead("_start").over(by_group)).alias(SCD_END))


def _spread(rows: DataFrame, parts: list[str], n: int) -> DataFrame:
    """``rows`` shuffled by ``parts`` into as many tasks as ``n`` rows need, where the session's number is too small."""
    tasks = tasks_for(n)
    return rows.repartition(tasks, *parts) if tasks > int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")) else rows


def scd2(changes: DataFrame, keys: list[str], sequence_by: str,
         track_history: list[str] | None = None, tiebreak: list[str] | None = None,
         segments: int | None = None, cuts: dict[int, list[float]] | None = None) -> DataFrame:
    """History table: keys, other columns, ``__START_AT``, ``__END_AT``.

    ``segments``: a key with over 1 / ``segments`` of the rows is cut (default: the session's shuffle partitions, at least
    16, and one for every ``ROWS_OF_A_TASK`` rows); ``cuts``: the cuts that ``hot_key_cuts`` gives, where they are known.
    Both shape the work, never the result.  Rows with a null key or a null sequence are ignored.
    """
    seq = sequence_by
    payload = [c for c in changes.columns if c not in keys and c != seq]
    tracked = list(track_history or payload)
    tiebreak = list(tiebreak or (tracked + [c for c in payload if c not in tracked]))
    not_null = F.col(seq).isNotNull()
    for k in keys:
        not_null = not_null & F.col(k).isNotNull()
    src = changes.where(not_null)
    n = 0
    if cuts is None:
        n, cuts = _count_and_cuts(src, keys, seq, segments)
    columns = [*keys, *payload, SCD_START, SCD_END]
    if not cuts:
        return _local_versions(_spread(src, keys, n), keys, seq, tracked, tiebreak).select(*columns)
    parts = [*keys, "_seg"]
    local = _local_versions(_spread(_segment(src, keys, seq, cuts), parts, n), parts, seq, tracked, tiebreak)
    hot = F.xxhash64(*keys).isin(list(cuts))
    stored = materialize(changes.sparkSession, local.withColumn("_edge", hot & (F.col("_first") | F.col("_last")))
                         .select(*columns, "_seg", "_first", "_last", "_edge"), "scd2-segments")
    merged = _merge_borders(stored.where("_edge"), keys, tracked, payload)         # at most two rows a segment
    return stored.where("not _edge").select(*columns).unionByName(merged.select(*columns))


def current(history: DataFrame) -> DataFrame:
    """Open versions (end is null) - one row per key."""
    return history.filter(F.col(SCD_END).isNull())


def closed(history: DataFrame) -> DataFrame:
    return history.filter(F.col(SCD_END).isNotNull())


def key_history(history: DataFrame, key: str, value) -> DataFrame:
    """All versions of one key; the equality filter reaches the source of the changes."""
    return history.filter(F.col(key) == F.lit(value))
