"""Embedding near-duplicates by an epsilon grid order join.

For unit vectors, cosine >= c means a distance of at most eps = sqrt(2 - 2 c).
Vectors are turned onto their principal axes, cut into grid cells of side eps on
the leading axes and sorted by (label, cell) over the cluster.  Runs of the
sorted sequence become blocks with a bounding box.  Two blocks are joined if
their boxes come within eps; blocks are matched by the strips of the first axis
that they touch, so distant blocks never meet.  Inside a block pair the two
sequence intervals are halved recursively, intervals whose boxes are more than
eps apart are skipped, and short intervals are compared by exact cosine in
double precision.

Equal vectors of a label are joined once and counted by their number.  A block
pair sends on the link count of each vector and a spanning forest of its links,
so a dense group costs rows in proportion to its vectors, not to its pairs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import save
from .components import components, forest

MIN_COSINE, AXES, BLOCK_ROWS, LEAF_ROWS = 0.98, 8, 1024, 128
_SLACK = 1e-9                                     # boxes are rounded, so pruning leaves this much room


def _matrix(column: pa.Array) -> np.ndarray:
    flat = np.asarray(column.flatten(), dtype=np.float64)
    return flat.reshape(len(column), -1)


def _unit(x: np.ndarray) -> np.ndarray:
    """Rows of length one; scaled by the largest component first, so squares neither overflow nor vanish."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def distinct_vectors(vectors: DataFrame) -> DataFrame:
    """Valid vectors once per label: (gid, label, embedding, dim, copies, vec_id), stored.

    Valid: label not null, at least one component, all components finite, not all zero.
    """
    e = F.col("embedding")
    ok = (F.col("label").isNotNull() & e.isNotNull() & (F.size(e) > 0)
          & F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(e, lambda x: x != 0))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "label", F.col("embedding").cast("array<double>").alias("embedding"))
    once = rows.where(ok).groupBy("label", "embedding").agg(F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("vec_id"))
    return save(once.select(F.monotonically_increasing_id().alias("gid"), "label", "embedding", F.size("embedding").alias("dim"),
                            "copies", "vec_id"), "ego-vectors")


def principal_axes(vectors: DataFrame, axes: int = AXES) -> dict[int, np.ndarray]:
    """Leading principal axes of the unit vectors, by dimension.

    Each task sums outer products; the sums of all tasks are added by Spark, so
    dim * dim numbers per dimension reach the driver.
    """
    def run(batches):
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            dims = np.asarray(b.column(1))
            for d in np.unique(dims).tolist():
                x = _unit(_matrix(b.column(0).filter(pa.array(dims == d))))
                sums[d] = sums.get(d, 0) + x.T @ x
        for d, m in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array(np.full(d * d, d, dtype=np.int32)), pa.array(np.arange(d * d, dtype=np.int64)),
                                              pa.array(m.ravel())], names=["dim", "at", "v"])

    rows = vectors.select("embedding", "dim").mapInArrow(run, "dim int, at long, v double").groupBy("dim", "at").agg(F.sum("v").alias("v"))
    got = rows.toPandas()
    out = {}
    for d, part in got.groupby("dim"):
        m = np.zeros(d * d)
        m[part["at"].to_numpy()] = part["v"].to_numpy()
        values, axes_of = np.linalg.eigh(m.reshape(d, d))
        out[int(d)] = axes_of[:, ::-1][:, :axes]
    return out


def blocks(vectors: DataFrame, eps: float, axes: dict[int, np.ndarray], block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The sequence in grid order as stored blocks: bid, label, dim, lo, hi (boxes on the leading axes),
    gid, copies (arrays) and x, p (unit vectors and their leading coordinates as bytes)."""
    def project(batches):
        for b in batches:
            dims = np.asarray(b.column(b.schema.get_field_index("dim")))
            e = b.column(b.schema.get_field_index("embedding"))
            p: list = [None] * b.num_rows
            for d in np.unique(dims).tolist():
                at = np.flatnonzero(dims == d)
                for i, row in zip(at, _unit(_matrix(e.take(pa.array(at)))) @ axes[d]):
                    p[i] = row
            cell = [np.floor(r / eps).astype(np.int32) for r in p]
            yield pa.RecordBatch.from_arrays(
                [*(b.column(b.schema.get_field_index(c)) for c in ("label", "dim", "gid", "copies", "embedding")),
                 pa.array(p, pa.list_(pa.float64())), pa.array(cell, pa.list_(pa.int32()))],
                names=["label", "dim", "gid", "copies", "embedding", "p", "cell"])

    label = vectors.schema["label"].dataType.simpleString()
    shape = f"label {label}, dim int, gid long, copies long, embedding array<double>, p array<double>, cell array<int>"
    n = vectors.count()
    parts = -(-n // (4 * block_rows)) + 1
    order = ["label", "dim", "cell", "gid"]
    placed = save(vectors.mapInArrow(project, shape), "ego-cells")
    # a session may deal out more ranges than asked for; full blocks need no more than these
    ordered = placed.repartitionByRange(parts, *order).coalesce(parts).sortWithinPartitions(*order)

    def cut(batches):
        part, number = TaskContext.get().partitionId(), 0
        held: list = []

        def close():
            nonlocal number, held
            t = pa.Table.from_batches(held).combine_chunks()
            x, p = _unit(_matrix(t["embedding"].chunk(0))), _matrix(t["p"].chunk(0))
            row = {"bid": (part << 32) + number, "label": t["label"][0].as_py(), "dim": t["dim"][0].as_py(),
                   "lo": p.min(axis=0).tolist(), "hi": p.max(axis=0).tolist(), "gid": t["gid"].to_pylist(),
                   "copies": t["copies"].to_pylist(), "x": x.tobytes(), "p": p.tobytes()}
            number, held = number + 1, []
            return pa.RecordBatch.from_pylist([row], schema=out)

        n_held, key = 0, None
        for b in batches:
            out = pa.schema([("bid", pa.int64()), ("label", b.schema.field("label").type), ("dim", pa.int32()),
                             ("lo", pa.list_(pa.float64())), ("hi", pa.list_(pa.float64())), ("gid", pa.list_(pa.int64())),
                             ("copies", pa.list_(pa.int64())), ("x", pa.binary()), ("p", pa.binary())])
            labels, dims = b.column(0).to_pylist(), b.column(1).to_pylist()
            at = 0
            while at < b.num_rows:
                if held and ((labels[at], dims[at]) != key or n_held >= block_rows):
                    yield close()
                    n_held = 0
                key, end = (labels[at], dims[at]), at
                while end < b.num_rows and (labels[end], dims[end]) == key and n_held < block_rows:
                    end, n_held = end + 1, n_held + 1
                held.append(b.slice(at, end - at))
                at = end
        if held:
            yield close()

    return save(ordered.mapInArrow(cut, f"bid long, label {label}, dim int, lo array<double>, hi array<double>, "
                                        "gid array<long>, copies array<long>, x binary, p binary"), "ego-blocks")


def block_pairs(table: DataFrame, eps: float) -> DataFrame:
    """(a, b), a <= b: blocks of one label and dimension whose boxes come within eps."""
    box = table.select("bid", "label", "dim", "lo", "hi")
    strip = lambda c: F.floor(F.element_at(c, 1) / eps)
    left = box.select(F.col("bid").alias("a"), "label", "dim", F.col("lo").alias("a_lo"), F.col("hi").alias("a_hi"),
                      strip("lo").alias("a_first"), F.explode(F.sequence(strip("lo"), strip("hi"))).alias("strip"))
    right = box.select(F.col("bid").alias("b"), "label", "dim", F.col("lo").alias("b_lo"), F.col("hi").alias("b_hi"),
                       (strip("lo") - 1).alias("b_first"), F.explode(F.sequence(strip("lo") - 1, strip("hi") + 1)).alias("strip"))
    gaps = F.zip_with(F.arrays_zip("a_lo", "a_hi"), F.arrays_zip("b_lo", "b_hi"), lambda x, y: F.greatest(
        F.lit(0.0), y["b_lo"] - x["a_hi"], x["a_lo"] - y["b_hi"]))
    apart = F.aggregate(gaps, F.lit(0.0), lambda s, g: s + g * g)
    return (left.join(right.hint("merge"), ["label", "dim", "strip"]).where("a <= b and strip = greatest(a_first, b_first)")
            .where(apart <= (eps + _SLACK) ** 2).select("a", "b"))


def join_intervals(xa, pa_, xb, pb, eps: float, cosine: float, same: bool, leaf: int = LEAF_ROWS):
    """Linked row pairs (i, j) of two sequence intervals; i < j where both are the same block."""
    out_i, out_j = [], []

    def apart(a0, a1, b0, b1):
        gap = np.maximum(0, np.maximum(pb[b0:b1].min(axis=0) - pa_[a0:a1].max(axis=0), pa_[a0:a1].min(axis=0) - pb[b0:b1].max(axis=0)))
        return (gap * gap).sum() > (eps + _SLACK) ** 2

    todo = [(0, len(xa), 0, len(xb))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        if same and b1 <= a0 or apart(a0, a1, b0, b1):
            continue
        if a1 - a0 <= leaf and b1 - b0 <= leaf:
            i, j = np.nonzero(xa[a0:a1] @ xb[b0:b1].T >= cosine)
            i, j = i + a0, j + b0
            keep = i < j if same else slice(None)
            out_i.append(i[keep])
            out_j.append(j[keep])
            continue
        a = [(a0, a1)] if a1 - a0 <= leaf else [(a0, (a0 + a1) // 2), ((a0 + a1) // 2, a1)]
        b = [(b0, b1)] if b1 - b0 <= leaf else [(b0, (b0 + b1) // 2), ((b0 + b1) // 2, b1)]
        todo += [(*x, *y) for x in a for y in b]
    none = np.zeros(0, dtype=np.int64)
    return (np.concatenate(out_i), np.concatenate(out_j)) if out_i else (none, none)


def _join(eps, cosine):
    def run(batches):
        for batch in batches:
            for r in range(batch.num_rows):
                row = {n: batch.column(i)[r].as_py() for i, n in enumerate(batch.schema.names)}
                d = row["dim"]
                side = {}
                for s in "ab":
                    side[s] = (np.frombuffer(row[f"{s}_x"]).reshape(-1, d), np.frombuffer(row[f"{s}_p"]).reshape(-1, len(row["lo"])),
                               np.array(row[f"{s}_gid"], dtype=np.int64), np.array(row[f"{s}_copies"], dtype=np.int64))
                same = row["a"] == row["b"]
                (xa, p1, ga, ca), (xb, p2, gb, cb) = side["a"], side["b"]
                i, j = join_intervals(xa, p1, xb, p2, eps, cosine, same)
                if not len(i):
                    continue
                gid = np.concatenate([ga[i], gb[j]])
                linked = np.concatenate([cb[j], ca[i]])
                ids, at = np.unique(gid, return_inverse=True)
                counts = np.bincount(at, weights=linked, minlength=len(ids)).astype(np.int64)
                u, v = forest(ga[i], gb[j])
                root = dict(zip(u.tolist(), v.tolist()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids), pa.array(counts), pa.array([root.get(g) for g in ids.tolist()], pa.int64())],
                    names=["gid", "n", "root"])
    return run


def near_links(vectors: DataFrame, cosine: float = MIN_COSINE, axes: int = AXES, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(gid, n, root) rows of a ``distinct_vectors`` table, stored: links found for a vector in a block pair
    (copies counted) and a vector of its component there (null for that vector itself)."""
    eps = float(np.sqrt(2 - 2 * cosine))
    table = blocks(vectors, eps, principal_axes(vectors, axes), block_rows)
    pairs = save(block_pairs(table, eps), "ego-pairs")
    a = table.select(F.col("bid").alias("a"), "dim", "lo", F.col("gid").alias("a_gid"), F.col("copies").alias("a_copies"),
                     F.col("x").alias("a_x"), F.col("p").alias("a_p"))
    b = table.select(F.col("bid").alias("b"), F.col("gid").alias("b_gid"), F.col("copies").alias("b_copies"), F.col("x").alias("b_x"),
                     F.col("p").alias("b_p"))
    both = pairs.join(a.hint("merge"), "a").join(b.hint("merge"), "b")
    return save(both.mapInArrow(_join(eps, cosine), "gid long, n long, root long"), "ego-links")


def near_duplicates(vectors: DataFrame, cosine: float = MIN_COSINE, **options) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row.

    Vectors that are null, empty, zero or hold null or non-finite components,
    and rows without a label, link with nothing and form their own component, as
    do vectors of different dimensions among each other.  Rows that repeat a
    vec_id are rows of their own.  An empty table gives an empty result; other
    columns are ignored.
    """
    once = distinct_vectors(vectors)
    found = near_links(once, cosine, **options)
    member = components(found.where("root is not null").select(F.col("gid").alias("u"), F.col("root").alias("v")))
    links = found.groupBy("gid").agg(F.sum("n").alias("n"))
    joined = (once.join(links, "gid", "left").join(member.withColumnRenamed("node", "gid"), "gid", "left")
              .select("gid", "label", "embedding", "copies", "vec_id", F.coalesce("n", F.lit(0)).alias("n"),
                      F.coalesce("component", "gid").alias("component")))
    joined = save(joined, "ego-members")
    low = joined.groupBy("component").agg(F.min("vec_id").alias("component_id"))
    named = joined.join(low, "component").select(
        F.col("label").alias("__l"), F.col("embedding").alias("__e"), (F.col("n") + F.col("copies") - 1).alias("__n"),
        F.col("component_id").alias("__c"))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "label", F.col("embedding").cast("array<double>").alias("embedding"))
    out = rows.join(named, (F.col("label") == F.col("__l")) & (F.col("embedding") == F.col("__e")), "left")
    component = F.coalesce("__c", "vec_id")
    return out.select("vec_id", F.coalesce("__n", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
                      F.col("vec_id").eqNullSafe(component).alias("kept"))
