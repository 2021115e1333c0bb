"""Best-fit packing by linear grouping.

Lengths are whole numbers up to the sequence size, so pieces of one length are
interchangeable and the instance is its length histogram (at most ``capacity``
counts, whatever the corpus).  The plan is made from that histogram:

1. pieces as long as a sequence stand alone;
2. large pieces, sorted by falling length, are cut into groups of equal
   cardinality and rounded up to the longest of their group;
3. the few rounded sizes are packed by configurations, optimised as a linear
   programme by column generation, rounded down, the rest by best fit;
4. the actual pieces take the slots of their group in rank order, which frees
   the room that rounding had added;
5. small pieces go by falling length into the fullest sequence that holds them,
   as many as fit, and into new sequences where none does.

Spark tokenises, counts and places: each task numbers its pieces within
(task, length), a window over the histogram turns that into a number within the
length, and the plan maps (length, number) to (sequence, offset).
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import save, slices, text_or_empty
from .tokens import encoder, tokenizer_path

CAPACITY = 2048
GROUPS = 192
SMALL_SHARE = 4


# --- the plan (driver side, size bounded by the sequence size) -----------------------------

def _price(sizes: np.ndarray, values: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """Most valuable configuration of rounded sizes (unbounded knapsack)."""
    most = capacity // int(sizes.min())
    room = np.arange(capacity + 1)[None, :] - sizes[:, None]
    open_, room = room >= 0, np.maximum(room, 0)
    best, picks = np.zeros(capacity + 1), []
    for _ in range(most):                                  # one more piece in each round
        gain = np.where(open_, best[room] + values[:, None], -1.0)
        pick = gain.argmax(axis=0)
        now = gain[pick, np.arange(capacity + 1)]
        better = now > best + 1e-12
        picks.append(np.where(better, pick, -1))
        if not better.any():
            break
        best = np.where(better, now, best)
    config = np.zeros(len(sizes), dtype=np.int64)
    c = capacity
    for pick in reversed(picks):
        if pick[c] >= 0:
            config[pick[c]] += 1
            c -= int(sizes[pick[c]])
    return float(config @ values), config


def configurations(sizes: np.ndarray, demand: np.ndarray, capacity: int,
                   rounds: int = 800) -> list[tuple[np.ndarray, int]]:
    """(configuration, sequences) covering the demand exactly: column generation, floor, best fit."""
    k = len(sizes)
    basis = [np.eye(k, dtype=np.int64)[i] * int(min(capacity // sizes[i], max(1, demand[i]))) for i in range(k)]
    inverse = np.linalg.inv(np.array(basis, dtype=float).T)
    for step in range(rounds):
        if step % 50 == 49:
            inverse = np.linalg.inv(np.array(basis, dtype=float).T)
        x = inverse @ demand
        duals = np.ones(k) @ inverse
        value, column = _price(sizes, duals, capacity)
        if value <= 1 + 1e-6:
            break
        way = inverse @ column
        ratio = np.where(way > 1e-9, np.maximum(x, 0) / np.where(way > 1e-9, way, 1), np.inf)
        out = int(ratio.argmin())
        if not np.isfinite(ratio[out]):
            break
        basis[out] = column
        pivot = inverse[out] / way[out]
        inverse = inverse - np.outer(way, pivot)
        inverse[out] = pivot
    x = np.maximum(np.linalg.inv(np.array(basis, dtype=float).T) @ demand, 0)
    plan, left = [], demand.astype(np.int64).copy()
    for column, share in zip(basis, x):
        n = int(np.floor(share + 1e-6))
        used = column > 0
        if used.any():
            n = min(n, int((left[used] // column[used]).min()))
        if n > 0:
            plan.append((column.copy(), n))
            left -= column * n
    bins: list[list] = []
    for i in np.argsort(-sizes, kind="stable"):
        for _ in range(int(left[i])):
            fits = [b for b in bins if b[0] >= sizes[i]]
            if fits:
                b = min(fits, key=lambda b: b[0])
            else:
                b = [capacity, np.zeros(k, dtype=np.int64)]
                bins.append(b)
            b[0] -= int(sizes[i])
            b[1][i] += 1
    merged: dict[tuple, int] = {}
    for _, column in bins:
        merged[tuple(column)] = merged.get(tuple(column), 0) + 1
    return plan + [(np.array(c), n) for c, n in merged.items()]


class Plan:
    """Maps (length, number within the length) to (sequence, offset)."""

    def __init__(self, hist: np.ndarray, capacity: int = CAPACITY, groups: int = GROUPS):
        self.capacity = capacity
        self.hist = np.zeros(capacity + 1, dtype=np.int64)
        self.hist[: len(hist)] = hist
        self.small = capacity // SMALL_SHARE
        self.sequences = int(self.hist[capacity])          # pieces that fill a sequence
        self._large(groups)
        self._best_fit()

    def _large(self, groups: int):
        cap, small = self.capacity, self.small
        lengths = np.arange(cap - 1, small, -1)
        counts = self.hist[lengths]
        self.lengths, self.rank_end = lengths, np.cumsum(counts)
        self.rank0 = self.rank_end - counts                # first rank of each length
        n = int(counts.sum())
        self.slot_lo = np.zeros(0, dtype=np.int64)
        self.slots: list[tuple] = []
        self.segments: list[tuple[int, int, int]] = []
        if not n:
            return
        size = -(-n // groups)
        edges = np.append(np.arange(0, n, size), n)
        top = self._length_at(edges[:-1])
        first = np.flatnonzero(np.append(True, top[1:] != top[:-1]))   # equal rounded sizes are one class
        edges, sizes = np.append(edges[:-1][first], n), top[first]
        cursor = edges[:-1].copy()
        for column, n_seq in configurations(sizes, np.diff(edges), cap):
            own: list[int] = []
            for g in np.flatnonzero(column):
                for _ in range(int(column[g])):
                    self.slots.append((int(cursor[g]), self.sequences, tuple(own)))
                    own.append(int(cursor[g]))
                    cursor[g] += n_seq
            cuts = {0, n_seq}
            for lo in own:
                inside = self.rank0[(self.rank0 > lo) & (self.rank0 < lo + n_seq)] - lo
                cuts.update(inside.tolist())
            cuts = np.array(sorted(cuts))
            room = cap - sum(self._length_at(lo + cuts[:-1]) for lo in own)
            for a, b, r in zip(cuts[:-1], cuts[1:], np.broadcast_to(room, len(cuts) - 1)):
                self.segments.append((self.sequences + int(a), self.sequences + int(b), int(r)))
            self.sequences += n_seq
        assert (cursor == edges[1:]).all(), "configurations must cover every piece once"
        self.slots.sort()
        self.slot_lo = np.array([s[0] for s in self.slots], dtype=np.int64)

    def _length_at(self, rank):
        return self.lengths[np.searchsorted(self.rank_end, rank, side="right")]

    def _best_fit(self):
        cap = self.capacity
        room: list[list] = [[] for _ in range(cap + 1)]
        for lo, hi, r in self.segments:
            room[r].append((lo, hi))
        placed = []                                        # length, first number, count, sequence, per sequence, offset
        for ell in range(min(self.small, cap - 1), 0, -1):
            n, at, v = int(self.hist[ell]), 0, ell
            while n:
                while v <= cap and not room[v]:
                    v += 1
                if v > cap:
                    fresh = -(-n // (cap // ell))
                    room[cap].append((self.sequences, self.sequences + fresh))
                    self.sequences += fresh
                    v = cap
                lo, hi = room[v].pop()
                each = v // ell
                q = min(hi - lo, n // each)
                if q == 0:
                    q, each = 1, n
                placed.append((ell, at, q * each, lo, each, cap - v))
                if v - each * ell:
                    room[v - each * ell].append((lo, lo + q))
                if lo + q < hi:
                    room[v].append((lo + q, hi))
                at += q * each
                n -= q * each
        self.placed = np.array(sorted(placed), dtype=np.int64).reshape(-1, 6)
        self.placed_key = (self.placed[:, 0] << 44) + self.placed[:, 1]

    def place(self, length: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        seq = np.zeros(len(length), dtype=np.int64)
        off = np.zeros(len(length), dtype=np.int64)
        full = length == self.capacity
        seq[full] = number[full]
        big = np.flatnonzero((length > self.small) & ~full)
        if len(big):
            rank = self.rank0[self.capacity - 1 - length[big]] + number[big]
            slot = np.searchsorted(self.slot_lo, rank, side="right") - 1
            j = rank - self.slot_lo[slot]
            for s in np.unique(slot):
                own = slot == s
                seq[big[own]] = self.slots[s][1] + j[own]
                for lo in self.slots[s][2]:
                    off[big[own]] += self._length_at(lo + j[own])
        low = np.flatnonzero(length <= self.small)
        if len(low):
            i = np.searchsorted(self.placed_key, (length[low] << 44) + number[low], side="right") - 1
            p = self.placed[i]
            r = number[low] - p[:, 1]
            seq[low] = p[:, 3] + r // p[:, 4]
            off[low] = p[:, 5] + (r % p[:, 4]) * length[low]
        return seq, off


# --- the job ------------------------------------------------------------------------------

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, k long"


def piece_table(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = 0) -> DataFrame:
    """Token pieces of whole texts, numbered within (task, length)."""

    def run(batches):
        part = TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, dtype=np.int64)
        enc = encoder(path)
        for whole in batches:
            for batch in slices(whole, "text", 4 << 20):
                ids, off = enc.encode(batch.column(1), end_id)
                n = np.diff(off)
                pieces = -(-n // capacity)
                doc = np.repeat(np.arange(len(n)), pieces)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                start = piece * capacity
                length = np.minimum(capacity, n[doc] - start)
                raw = memoryview(ids.astype("<u4", copy=False)).cast("B")
                lo = (off[:-1][doc] + start) * 4
                crc = np.fromiter((zlib.crc32(raw[a:b]) for a, b in zip(lo.tolist(), (lo + length * 4).tolist())),
                                  dtype=np.int64, count=len(doc))
                order = np.argsort(length, kind="stable")
                _, first, counts = np.unique(length[order], return_index=True, return_counts=True)
                k = np.empty(len(doc), dtype=np.int64)
                k[order] = np.arange(len(doc)) - np.repeat(first, counts)
                k += seen[length]
                np.add.at(seen, length, 1)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(doc)), pa.array(piece.astype(np.int32)), pa.array(start),
                     pa.array(length), pa.array(crc), pa.array(np.full(len(doc), part, dtype=np.int32)), pa.array(k)],
                    names=["doc_id", "piece", "start", "length", "ids_crc32", "part", "k"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")).mapInArrow(run, PIECES)


def pack(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, end_id: int = 0,
         groups: int = GROUPS) -> DataFrame:
    """One row per piece with its sequence and offset.

    Null texts count as empty (one piece holding the end id); a null doc_id is
    kept; repeated rows are packed as often as they occur; an empty table gives
    an empty result; other columns are ignored.
    """
    spark = docs.sparkSession
    pieces = save(piece_table(docs, tokenizer or tokenizer_path(), capacity, end_id), "pieces")
    counts = save(pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n")), "piece-counts")
    hist = np.zeros(capacity + 1, dtype=np.int64)
    for row in counts.groupBy("length").agg(F.sum("n").alias("n")).collect():   # at most `capacity` rows
        hist[row["length"]] = row["n"]
    plan = spark.sparkContext.broadcast(Plan(hist, capacity, groups))

    def place(batches):
        for b in batches:
            number = np.asarray(b.column(5)) + np.asarray(b.column(6))
            seq, off = plan.value.place(np.asarray(b.column(3)), number)
            yield pa.RecordBatch.from_arrays(
                [b.column(i) for i in range(5)] + [pa.array(seq), pa.array(off)],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    return (pieces.join(first, ["part", "length"])
            .select("doc_id", "piece", "start", "length", "ids_crc32", "k", "first")
            .mapInArrow(place, "doc_id long, piece int, start long, length long, ids_crc32 long, "
                               "sequence_id long, offset long"))
