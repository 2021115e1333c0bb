"""Hard negatives by rotated one-bit codes with deterministic bounds.

A vector's direction r is turned by a fixed random rotation and kept as one bit
per component, b = sign / sqrt(d), with its alignment a = <r, b>: r = a b + e, e
orthogonal to b.  The remainder e is coded again under a rotation of its own, so
each of the ``levels`` codes adds a term and leaves a shorter remainder.  For a query
direction q, <q, b> is estimated by popcounts of the code against a few bit planes of
the rotated query, whose rounding error is a known length; the remainder adds at most
|q - <q, b> b| |e| by Cauchy and Schwarz.  That gives each score an interval that
surely holds it.

A block of queries meets a group of rows.  The rows with the best estimates are
scored in integers, which sets a bound that the k-th best score reaches at least; rows
whose interval lies below the bound, or outside the wanted window, are passed over,
code by code, and the surviving ones are scored in integers.  So results are
exact, ties included.

The rows are dealt into groups (about the eightfold root of their number, at least
4,096 and at most 131,072 rows); a group with its codes is held by one task, and
all queries stream past it.  Each group sends on its first k rows of a query, and
the first k of all groups are taken by a window over one query's rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import save

SCALE, LEVELS, BLOCK_LEVELS, PLANES = 256, 4, 3, 6
POSITIVES, NEGATIVES, LOW, HIGH = 5, 10, 30, 90
LEAST_ROWS, MOST_ROWS, QUERY_BLOCK = 4096, 131072, 512
_CELLS = 1 << 18                                  # (query, row) pairs looked at together
_LIMIT = 1 << 27                                  # largest integer component, so that scores fit 64 bits
_NEVER = np.iinfo(np.int64).min


def integer_rows(vectors: DataFrame) -> DataFrame:
    """Rows that take part, stored: gid, vec_id, label, dim, y (integer components)."""
    e = F.col("embedding")
    ok = (F.col("vec_id").isNotNull() & F.col("label").isNotNull() & e.isNotNull() & (F.size(e) > 0)
          & F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    y = F.transform(e, lambda x: F.greatest(F.lit(-float(_LIMIT)), F.least(F.lit(float(_LIMIT)), F.floor(F.lit(float(SCALE)) * x.cast("double")).cast("double"))).cast("int"))
    rows = vectors.where(ok).select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), y.alias("y"))
    return save(rows.select(F.monotonically_increasing_id().alias("gid"), "vec_id", "label", F.size("y").alias("dim"), "y"), "hn-rows")


def rotations(dim: int, levels: int) -> np.ndarray:
    """One random rotation for each level, the same in every task."""
    rng = np.random.default_rng(dim)
    return np.stack([np.linalg.qr(rng.standard_normal((dim, dim)))[0] for _ in range(levels)])


def _units(y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    x = y.astype(np.float64)
    norm = np.sqrt((x * x).sum(axis=1))
    return x / np.where(norm > 0, norm, 1)[:, None], norm


def encode(y: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(codes [n, levels, words] of 64 bits, alignments [n, levels], lengths of the remainders [n, levels])."""
    e, _ = _units(y)
    n, d = y.shape
    codes, align, rest = [], [], []
    for r in turn:
        t = e @ r.T
        bits = t >= 0
        b = np.where(bits, 1.0, -1.0) / np.sqrt(d)
        a = (t * b).sum(axis=1)
        e = (t - a[:, None] * b) @ r
        packed = np.zeros((n, -(-d // 64) * 8), dtype=np.uint8)
        packed[:, :-(-d // 8)] = np.packbits(bits, axis=1, bitorder="little")
        codes.append(packed.view(np.uint64))
        align.append(a)
        rest.append(np.sqrt((e * e).sum(axis=1)))
    return np.stack(codes, axis=1), np.stack(align, axis=1), np.stack(rest, axis=1)


def planes(y: np.ndarray, turn: np.ndarray, n_planes: int = PLANES):
    """Rotated queries in bit planes: (planes [n, levels, n_planes, words], step, low, sum, error, each [n, levels])."""
    q, _ = _units(y)
    n, d = y.shape
    out, step, low, total, err = [], [], [], [], []
    for r in turn:
        t = q @ r.T
        lo = t.min(axis=1)
        s = np.maximum((t.max(axis=1) - lo) / (2**n_planes - 1), 1e-300)
        u = np.clip(np.rint((t - lo[:, None]) / s[:, None]), 0, 2**n_planes - 1).astype(np.int64)
        near = u * s[:, None] + lo[:, None]
        bits = (u[:, None, :] >> np.arange(n_planes)[None, :, None] & 1).astype(bool)
        packed = np.zeros((n, n_planes, -(-d // 64) * 8), dtype=np.uint8)
        packed[..., :-(-d // 8)] = np.packbits(bits, axis=2, bitorder="little")
        out.append(packed.view(np.uint64))
        for into, v in ((step, s), (low, lo), (total, near.sum(axis=1)), (err, np.sqrt(((t - near) ** 2).sum(axis=1)))):
            into.append(v)
    return np.stack(out, axis=1), *(np.stack(x, axis=1) for x in (step, low, total, err))


class Group:
    """Rows of one group with their codes, in order of label."""

    def __init__(self, dim: int, gid, vec_id, label, y, levels: int = LEVELS):
        order = np.lexsort((gid, vec_id, label))
        self.gid, self.vec_id, self.label, self.y = gid[order], vec_id[order], label[order], y[order]
        self.dim, self.turn = dim, rotations(dim, levels)
        self.codes, self.align, self.rest = encode(self.y, self.turn)
        self.ones = np.bitwise_count(self.codes).sum(axis=2).astype(np.float64)
        self.norm = _units(self.y)[1]
        self.most = int(np.abs(self.y).max(initial=0))
        self.small = self.most < 2**15

    def _product(self, q, level, i=None, j=None):
        """Estimated <q, b>: of all queries with all rows, or of the pairs (i, j)."""
        plane, step, low, total, _ = q
        code = self.codes[:, level]
        count = 0
        for k in range(plane.shape[2]):
            if i is None:
                both = sum(np.bitwise_count(plane[:, level, k, w, None] & code[None, :, w]).astype(np.int32) for w in range(code.shape[1]))
            else:
                both = sum(np.bitwise_count(plane[i, level, k, w] & code[j, w]).astype(np.int32) for w in range(code.shape[1]))
            count = count + (both << k)
        of = (slice(None), None) if i is None else i
        ones = self.ones[None, :, level] if i is None else self.ones[j, level]
        return (2 * (step[:, level][of] * count + low[:, level][of] * ones) - total[:, level][of]) / np.sqrt(self.dim)

    def _bounds(self, q, level, before, i=None, j=None):
        """(estimate, rounding, half width) of the cosines by the codes up to ``level``; ``before`` holds the sums of the earlier ones."""
        err = q[4][:, level][(slice(None), None) if i is None else i]
        align, rest = (x[None, :, level] if i is None else x[j, level] for x in (self.align, self.rest))
        x = self._product(q, level, i, j)
        est, slip = before[0] + align * x, before[1] + align * err
        near = np.maximum(np.abs(x) - err, 0)
        return est, slip, slip + np.sqrt(np.maximum(1 - near * near, 0)) * rest + 1e-9

    def scores(self, y, i, j):
        """Integer inner products, in 32 bits where they surely fit."""
        kind = np.int32 if self.small and np.abs(y).max(initial=0) < 2**15 and self.dim * int(np.abs(y).max(initial=0)) * self.most < 2**31 else np.int64
        a, b = y.astype(kind), self.y.astype(kind)
        out = np.empty(len(i), dtype=np.int64)
        for lo in range(0, len(i), 1 << 14):
            part = slice(lo, lo + (1 << 14))
            out[part] = np.einsum("nd,nd->n", a[i[part]], b[j[part]])
        return out

    def first(self, y, planes_of, wanted, windows, k: int):
        """Yield (window number, query, row, score): the first ``k`` rows of each query in each window.

        ``wanted``: boolean [queries, rows]; ``windows``: pairs of arrays (least, greatest score) per query.
        The leading codes meet as whole blocks, the others only for the pairs that are left.
        """
        if not windows:
            return
        levels = self.codes.shape[1]
        unit = _units(y)[1][:, None] * self.norm[None, :]
        est, slip = 0.0, 0.0
        for level in range(min(BLOCK_LEVELS, levels)):
            est, slip, half = self._bounds(planes_of, level, (est, slip))
        guess = np.where(wanted, est * unit, -np.inf)
        bounds = [np.maximum(least, self._reached(y, guess, least, most, k)) for least, most in windows]
        low = np.min(bounds, axis=0)
        high = np.max([most for _, most in windows], axis=0)
        a, b = np.nonzero(wanted & ((est + half) * unit >= low[:, None]) & ((est - half) * unit <= high[:, None]))
        e, s = est[a, b], slip[a, b]
        for level in range(BLOCK_LEVELS, levels):
            e, s, h = self._bounds(planes_of, level, (e, s), a, b)
            u = unit[a, b]
            left = ((e + h) * u >= low[a]) & ((e - h) * u <= high[a])
            a, b, e, s = a[left], b[left], e[left], s[left]
        score = self.scores(y, a, b)
        order = np.lexsort((self.gid[b], self.vec_id[b], -score, a))
        a, b, score = a[order], b[order], score[order]
        for w, (bound, (_, most)) in enumerate(zip(bounds, windows)):
            inside = np.flatnonzero((score >= bound[a]) & (score <= most[a]))
            own = a[inside]
            top = inside[np.arange(len(own)) - np.searchsorted(own, own) < k]
            yield w, a[top], b[top], score[top]

    def _reached(self, y, guess, least, most, k):
        """For each query a score that its k-th best row reaches at least; the smallest integer where unknown."""
        guess = np.where(guess <= most[:, None], guess, -np.inf)
        n, m = guess.shape
        out = np.full(n, _NEVER)
        if m < k:
            return out
        at = np.argpartition(guess, m - k, axis=1)[:, m - k:]
        known = np.isfinite(np.take_along_axis(guess, at, axis=1)).all(axis=1)
        rows = np.flatnonzero(known)
        if len(rows):
            score = self.scores(y, np.repeat(rows, k), at[rows].ravel()).reshape(-1, k)
            inside = ((score >= least[rows, None]) & (score <= most[rows, None])).all(axis=1)
            out[rows[inside]] = score[inside].min(axis=1)
        return out


def _ints(column: pa.Array, dim: int) -> np.ndarray:
    return np.asarray(column.flatten(), dtype=np.int64).reshape(-1, dim)


def _per_group(work, out: pa.Schema, levels: int):
    """Tasks see (dim, grp, kind, ...) sorted: a group's rows (kind 0), then the queries (kind 1) that pass it."""
    def run(batches):
        key, held, group = None, [], None
        queries: list = []

        def flush():
            nonlocal queries, group
            if queries and held:
                if group is None:
                    t = pa.Table.from_batches(held).combine_chunks()
                    col = lambda c: np.asarray(t[c].combine_chunks())
                    group = Group(key[0], col("gid"), col("vec_id"), col("label"), _ints(t["y"].combine_chunks(), key[0]), levels)
                t = pa.Table.from_batches(queries).combine_chunks()
                yield from work(group, t)
            queries = []

        for b in batches:
            dim, grp, kind = (np.asarray(b.column(i)) for i in range(3))
            cuts = np.flatnonzero((np.diff(dim) != 0) | (np.diff(grp) != 0) | (np.diff(kind) != 0)) + 1
            for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), b.num_rows]):
                if hi == lo:
                    continue
                if (int(dim[lo]), int(grp[lo])) != key:
                    yield from flush()
                    key, held, group = (int(dim[lo]), int(grp[lo])), [], None
                (queries if kind[lo] else held).append(b.slice(lo, hi - lo))
                if kind[lo] and sum(q.num_rows for q in queries) >= QUERY_BLOCK:
                    yield from flush()
        yield from flush()
    return run


def _batches(group: Group, t: pa.Table):
    """Blocks of queries small enough that a block meets the group at once: (first, integer rows, bit planes)."""
    y = _ints(t["y"].combine_chunks(), group.dim)
    size = max(1, _CELLS // max(1, len(group.y)))
    for lo in range(0, len(y), size):
        part = y[lo:lo + size]
        yield lo, part, planes(part, group.turn)


def _positives(k: int):
    def work(group: Group, t: pa.Table):
        gid, vec, label = (np.asarray(t[c].combine_chunks()) for c in ("gid", "vec_id", "label"))
        for lo, y, coded in _batches(group, t):
            part = slice(lo, lo + len(y))
            wanted = (label[part, None] == group.label[None, :]) & (gid[part, None] != group.gid[None, :])
            open_ = np.full(len(y), _NEVER), np.full(len(y), np.iinfo(np.int64).max)
            for _, a, b, score in group.first(y, coded, wanted, [open_], k):
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (gid[part][a], group.gid[b], group.vec_id[b], score)],
                                                 names=["a", "gid", "vec_id", "score"])
    return work


def _negatives(k: int, low: int, high: int):
    def work(group: Group, t: pa.Table):
        gid, label = np.asarray(t["gid"].combine_chunks()), np.asarray(t["label"].combine_chunks())
        found = t["positives"].combine_chunks()
        counts = np.asarray(found.value_lengths())
        flat = np.asarray(found.flatten().field("score"))
        start = np.concatenate([[0], np.cumsum(counts)])
        for lo, y, coded in _batches(group, t):
            part = slice(lo, lo + len(y))
            wanted = label[part, None] != group.label[None, :]
            windows = []
            for m in range(int(counts[part].max(initial=0))):
                has = counts[part] > m
                p = np.where(has, flat[np.minimum(start[:-1][part] + m, len(flat) - 1)], 0)
                least = -((-low * p) // 100)                       # 100 * negative >= low * positive
                windows.append((np.where(has, least, np.iinfo(np.int64).max), np.where(has, high * p // 100, _NEVER)))
            for m, a, b, score in group.first(y, coded, wanted, windows, k):
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (gid[part][a], np.full(len(a), m, dtype=np.int32), group.gid[b], group.vec_id[b], score)],
                                                 names=["a", "m", "gid", "vec_id", "score"])
    return work


def _meet(rows: DataFrame, queries: DataFrame, groups: dict[int, int], work, shape: str, levels: int) -> DataFrame:
    """Every query past every group of its dimension."""
    n_groups = F.element_at(F.create_map(*[F.lit(x) for kv in groups.items() for x in kv]), F.col("dim"))
    same = [c for c in queries.columns if c not in rows.columns]
    empty = [F.lit(None).cast(queries.schema[c].dataType).alias(c) for c in same]
    dealt = rows.select("dim", F.pmod(F.xxhash64("gid"), n_groups).cast("int").alias("grp"), F.lit(0).alias("kind"),
                        "gid", "vec_id", "label", "y", *empty)
    asked = queries.select("dim", F.explode(F.sequence(F.lit(0), (n_groups - 1).cast("int"))).alias("grp"), F.lit(1).alias("kind"),
                           "gid", "vec_id", "label", "y", *same)
    total = sum(groups.values())
    return (dealt.unionByName(asked).repartition(total, "dim", "grp").sortWithinPartitions("dim", "grp", "kind", "gid")
            .mapInArrow(_per_group(work, None, levels), shape))


def _first(found: DataFrame, keys: list[str], k: int, rank: str) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "vec_id", "gid")
    return found.withColumn(rank, F.row_number().over(order)).where(F.col(rank) <= k)


def mine(vectors: DataFrame, is_anchor, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH,
         levels: int = LEVELS, rows_per_group: int | None = None) -> DataFrame:
    """Hard negatives of the rows for which the column ``is_anchor`` (over vec_id, label) holds.

    Returns anchor_id, positive_id, rank, negative_id, positive_score, negative_score.  Scores are inner products of the
    components floor(256 x); a positive's negatives have ``low`` to ``high`` per cent of its score.  Rows without a
    vec_id, a label, a vector, or with a null, NaN or infinite component take no part; rows of another dimension than the
    anchor's are never compared with it; a zero vector scores 0.  Components beyond 2^27 / 256 in size count as
    that bound, so scores fit 64 bits.  Rows that repeat a vec_id are rows of their own (the copy of an anchor is a
    positive of it), ties among them by their place in the stored table.  An empty table, or one without
    anchors, gives an empty result; other columns are ignored.
    """
    rows = integer_rows(vectors)
    groups = {}
    for dim, n in rows.groupBy("dim").count().collect():                          # as many rows as there are vector lengths
        size = rows_per_group or int(min(MOST_ROWS, max(LEAST_ROWS, 8 * n ** 0.5)))
        groups[dim] = -(-n // size)
    if not groups:
        groups = {1: 1}
    asked = rows.where(is_anchor)
    best = _meet(rows, asked, groups, _positives(positives), "a long, gid long, vec_id long, score long", levels)
    best = _first(best, ["a"], positives, "rank").groupBy("a").agg(
        F.array_sort(F.collect_list(F.struct("rank", "vec_id", "score"))).alias("positives"))      # at most ``positives`` each
    queries = save(asked.join(best, asked["gid"] == best["a"]).drop("a"), "hn-queries")
    far = _meet(rows, queries, groups, _negatives(negatives, low, high), "a long, m int, gid long, vec_id long, score long", levels)
    far = _first(far, ["a", "m"], negatives, "rank")
    named = far.join(queries.select(F.col("gid").alias("a"), F.col("vec_id").alias("anchor_id"), "positives"), "a")
    p = F.col("positives")[F.col("m")]
    return named.select("anchor_id", p["vec_id"].alias("positive_id"), F.col("rank").cast("int").alias("rank"),
                        F.col("vec_id").alias("negative_id"), p["score"].alias("positive_score"), F.col("score").alias("negative_score"))


def hard_negatives(vectors: DataFrame) -> DataFrame:
    """The contract of the registered query: labels of every seventh vec_id moved on by one, anchors every hundredth vec_id."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(vectors.select("vec_id", moved.alias("label"), "embedding"), F.col("vec_id") % 100 == 0)
