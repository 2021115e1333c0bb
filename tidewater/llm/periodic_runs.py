"""Periodic runs of words, by recompression.

A run is a stretch of consecutive words with smallest period q and a length of
at least max(6, 4 q) that no neighbouring word extends.  In such a stretch the
words q apart agree over at least max(5, 3 q) places in a row, so one of them is
a multiple of that number.  Candidates are therefore the places of a harmonic grid
(every 3 p-th place for each period p, every fifth for p = 1) where the word,
and the two words after or before it, return p places later.

How far a candidate reaches is answered by longest common extensions over a
run-length grammar.  The grammar is built by recompression over the documents
that have candidates: block compression replaces each maximal repetition of a
symbol, pair compression splits the alphabet in two and replaces every pair of a
symbol of the first part before one of the second; both name equal content
equally, so equal stretches are parsed alike but for their ends.  An extension
walks the two places up the levels while both begin a symbol's content and down
again where they differ; repetitions are skipped as a whole.  Names are
ranks of sorted pairs, not hashes, so extensions are exact.

Documents are independent: the job is one map over the rows, in pieces of a few
megabytes of text, and a task holds about 150 bytes per word of its longest text.
"""

from __future__ import annotations

import hashlib
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import list_offsets, slices, text_or_empty
from .words import split_words

MIN_LENGTH, MIN_PERIODS = 6, 4
_CHUNK = 1 << 20                                  # candidates looked at together


def _ranks(codes: np.ndarray) -> np.ndarray:
    return np.unique(codes, return_inverse=True)[1].astype(np.int64)


class Grammar:
    """Run-length grammar of a symbol sequence, all levels as flat node arrays.

    The sequence must begin and end with symbols that occur once, which stop
    every extension.  ``extend`` answers many queries together.
    """

    def __init__(self, symbols: np.ndarray):
        level = _ranks(symbols)
        sym, first, last, up = [level], [np.full(len(level), -1)], [np.full(len(level), -1)], []
        base, turn = 0, 0
        while len(level) > 1:
            joined = (level[1:] == level[:-1]) if turn % 2 == 0 else self._pairs(level, turn)
            turn += 1
            if not joined.any():
                if turn > 256:
                    break
                continue
            starts = np.flatnonzero(np.concatenate([[True], ~joined]))
            ends = np.append(starts[1:], len(level)) - 1
            size, n = ends - starts + 1, int(level.max()) + 1
            tail = np.where(size == 1, 0, size if turn % 2 else level[ends] + 1)
            name = _ranks(level[starts] * (int(tail.max()) + 1) + tail) if n * (int(tail.max()) + 1) < 2**62 else _ranks_of_two(level[starts], tail)
            here = base
            base += len(level)
            up.append(base + np.cumsum(np.concatenate([[False], ~joined])))
            sym.append(name)
            first.append(here + starts)
            last.append(here + ends)
            level = name
        up.append(np.full(len(level), -1))
        self.sym, self.first, self.last, self.up = (np.concatenate(x) for x in (sym, first, last, up))
        widths = [len(s) for s in sym]
        self.leaf = np.empty(base + len(level), dtype=np.int64)      # text place at which a node's content begins
        self.leaf[:widths[0]] = np.arange(widths[0])
        for lo, w in zip(np.cumsum(widths)[:-1], widths[1:]):
            self.leaf[lo:lo + w] = self.leaf[self.first[lo:lo + w]]
        self.n = widths[0]

    @staticmethod
    def _pairs(level: np.ndarray, turn: int) -> np.ndarray:
        """Places whose symbol joins the next one: of two ways to split the alphabet, the one that joins more."""
        mixed = (level + turn * 7919).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        left = (mixed ^ (mixed >> np.uint64(29))) >> np.uint64(45) & np.uint64(1) == 1
        one, other = left[:-1] & ~left[1:], ~left[:-1] & left[1:]
        return one if one.sum() >= other.sum() else other

    def extend(self, a: np.ndarray, b: np.ndarray, forward: bool) -> np.ndarray:
        """Number of equal symbols from places ``a`` and ``b`` on, to the right or to the left (the places included)."""
        step, edge = (1, self.first) if forward else (-1, self.last)
        other = self.last if forward else self.first
        x, y = a.astype(np.int64).copy(), b.astype(np.int64).copy()
        out = np.zeros(len(x), dtype=np.int64)
        rows, rising = np.arange(len(x)), np.ones(len(x), dtype=bool)
        while len(rows):
            same = self.sym[x] == self.sym[y]
            ux, uy = self.up[x], self.up[y]
            top = ux < 0
            # up, while both stand at the edge of their parents and the parents are equal
            climb = rising & same & ~top
            climb &= (edge[ux] == x) & (edge[uy] == y)
            climb &= self.sym[ux] == self.sym[uy]
            # along: equal symbols; a repetition is left as a whole on the shorter side
            along = same & ~climb
            far = np.where(top, 1, np.minimum(np.abs(other[ux] - x), np.abs(other[uy] - y)) + 1)
            far = np.where(~top & self._repeats(ux) & self._repeats(uy), far, 1)
            down = ~same & (self.first[x] >= 0)
            done = ~same & (self.first[x] < 0)
            if done.any():
                out[rows[done]] = (x[done] - a[rows[done]]) * step
            x = np.where(climb, ux, np.where(along, x + step * far, np.where(down, edge[x], x)))
            y = np.where(climb, uy, np.where(along, y + step * far, np.where(down, edge[y], y)))
            rising &= ~down
            left = ~done
            x, y, rows, rising = x[left], y[left], rows[left], rising[left]
        return out

    def _repeats(self, node: np.ndarray) -> np.ndarray:
        """Nodes whose first two children are equal: blocks."""
        lo = self.first[node]
        return (self.last[node] > lo) & (self.sym[lo] == self.sym[np.minimum(lo + 1, len(self.sym) - 1)])


def _ranks_of_two(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.unique(np.stack([a, b], axis=1), axis=0, return_inverse=True)[1].ravel().astype(np.int64)


def candidates(ids: np.ndarray, off: np.ndarray, min_length: int = MIN_LENGTH, min_periods: int = MIN_PERIODS):
    """Pieces of (document, place, period) arrays: places of the harmonic grid where the word and two neighbours return.

    ``ids`` are the words of all documents in order, ``off`` the documents' offsets.
    """
    n = np.diff(off)
    most = np.where(n >= min_length, n // min_periods, 0)
    doc = np.repeat(np.arange(len(n)), most)
    p = np.arange(len(doc)) - np.repeat(np.cumsum(most) - most, most) + 1
    grid = np.maximum((min_periods - 1) * p, min_length - p)
    count = -(-(n[doc] - p) // grid)
    ends = np.cumsum(count)
    lo = 0
    while lo < len(doc):
        hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + _CHUNK, side="right")))
        c = count[lo:hi]
        k = np.arange(int(c.sum())) - np.repeat(np.cumsum(c) - c, c)
        d, q, g = np.repeat(doc[lo:hi], c), np.repeat(p[lo:hi], c), np.repeat(grid[lo:hi], c)
        at = k * g + off[d]
        hit = np.flatnonzero(ids[at] == ids[at + q])
        d, q, g, at = d[hit], q[hit], g[hit], at[hit]
        first, end = off[d], off[d + 1]

        def returns(shift):
            z = at + shift
            ok = (z >= first) & (z + q < end)
            ok[ok] = ids[z[ok]] == ids[z[ok] + q[ok]]
            return ok

        keep = (returns(1) & returns(2)) | (returns(-1) & returns(-2)) | (g < 5)
        yield d[keep], at[keep], q[keep]
        lo = hi


def runs_of(ids: np.ndarray, off: np.ndarray, min_length: int = MIN_LENGTH, min_periods: int = MIN_PERIODS):
    """(document, start, length, period) arrays of all runs, sorted; ``start`` counts within the document."""
    used = np.unique(np.concatenate([np.zeros(0, dtype=np.int64), *(np.unique(c[0]) for c in candidates(ids, off, min_length, min_periods))]))
    if not len(used):
        return used, used, used, used
    # the documents with candidates, each behind a symbol of its own, and one more at the end
    sizes = off[used + 1] - off[used]
    part = list_offsets(sizes)
    own = ids[np.repeat(off[used] - part[:-1], sizes) + np.arange(int(part[-1]))]
    seq = np.empty(len(own) + len(used) + 1, dtype=np.int64)
    place = np.ones(len(seq), dtype=bool)
    place[part + np.arange(len(part))] = False
    seq[place] = own
    seq[~place] = int(ids.max()) + 1 + np.arange(len(part))
    g = Grammar(seq)
    found = [np.zeros((0, 4), dtype=np.int64)]
    for doc, at, p in candidates(own, part, min_length, min_periods):
        i = at + doc + 1
        ahead = g.extend(i, i + p, True)
        back = g.extend(i, i + p, False) - 1
        length = back + ahead + p
        ok = length >= np.maximum(min_length, min_periods * p)
        found.append(_once(np.stack([doc, at - part[doc] - back, length, p], axis=1)[ok]))
    doc, start, length, p = _once(np.concatenate(found)).T
    order = np.lexsort((p, start, doc))
    return used[doc[order]], start[order], length[order], p[order]


def _once(rows: np.ndarray) -> np.ndarray:
    """Rows (document, start, length, period), each stretch once with its smallest period."""
    rows = rows[np.lexsort(rows.T[::-1])]
    new = np.ones(len(rows), dtype=bool)
    new[1:] = (rows[1:, :3] != rows[:-1, :3]).any(axis=1)
    return rows[new]


def kept_words(n_words: int, off: np.ndarray, doc, start, length, p) -> np.ndarray:
    """Words that no run holds after its first period."""
    edge = np.zeros(n_words + 1, dtype=np.int64)
    np.add.at(edge, off[doc] + start + p, 1)
    np.add.at(edge, off[doc] + start + length, -1)
    return np.cumsum(edge)[:-1] == 0


def planted(words: pa.Array, off: np.ndarray, doc_ids: list) -> pa.Array:
    """The contract's words: of every tenth document by crc32 of its id, a tail that repeats."""
    import zlib
    take = None
    for i, d in enumerate(doc_ids):
        n = int(off[i + 1] - off[i])
        h = zlib.crc32(str(d).encode()) if d is not None else 1
        if n == 0 or h % 10:
            continue
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        if take is None:
            take = np.arange(len(words))
        take[off[i] + a:off[i + 1]] = off[i] + a + np.arange(n - a) % p
    return words if take is None else words.take(pa.array(take))


def runs_in(words: pa.Array, off: np.ndarray):
    """Runs and collapsed texts of a piece: (document, start, length, period) arrays and an array of texts."""
    ids = np.asarray(words.dictionary_encode().indices).astype(np.int64)
    doc, start, length, p = runs_of(ids, off)
    kept = kept_words(len(ids), off, doc, start, length, p)
    held = words.filter(pa.array(kept)) if not kept.all() else words
    bounds = list_offsets(kept)[off]
    texts = pc.binary_join(pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), held), pa.scalar(" ", pa.large_string()))
    return doc, start, length, p, texts


SCHEMA = ("doc_id long, n_runs long, start long, length long, period long, exponent_milli long, "
          "runs_sha256 string, collapsed_sha256 string")


def _digest(doc_ids: pa.Array, words: pa.Array, off: np.ndarray) -> pa.RecordBatch:
    doc, start, length, p, texts = runs_in(words, off)
    lo = np.searchsorted(doc, np.arange(len(doc_ids) + 1))
    cols: list[list] = [[] for _ in range(7)]
    for i, text in enumerate(texts):
        rows = list(zip(start[lo[i]:lo[i + 1]].tolist(), length[lo[i]:lo[i + 1]].tolist(), p[lo[i]:lo[i + 1]].tolist()))
        best = max(rows, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
        listed = "".join(f"{s},{n},{q}\n" for s, n, q in rows)
        values = (len(rows), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
                  hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(text.as_buffer() or b"").hexdigest())
        for c, v in zip(cols, values):
            c.append(v)
    types = [pa.int64()] * 5 + [pa.string()] * 2
    return pa.RecordBatch.from_arrays([doc_ids, *(pa.array(c, t) for c, t in zip(cols, types))],
                                      names=["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"])


def _per_document(plant: bool):
    def run(batches):
        for batch in batches:
            for b in slices(batch, "text", 4 << 20):
                words, off = split_words(b.column(1))
                yield _digest(b.column(0), planted(words, off, b.column(0).to_pylist()) if plant else words, off)
    return run


def periodic_runs(docs: DataFrame, plant: bool = False) -> DataFrame:
    """doc_id, n_runs, the run of the greatest exponent, and digests of all runs and of the collapsed text, per row.

    ``plant`` first gives every tenth document a repeating tail, as the
    contract of the registered query asks.  A null text is an empty one; an
    empty text has no runs, null run columns and the digests of empty strings.  Rows that repeat, or share a
    doc_id, are rows of their own; a null doc_id stays null and is never
    planted.  Other columns are ignored; an empty table gives an empty result.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return rows.mapInArrow(_per_document(plant), SCHEMA)


def _spans(batches):
    for batch in batches:
        for b in slices(batch, "text", 4 << 20):
            words, off = split_words(b.column(1))
            doc, start, length, p, texts = runs_in(words, off)
            lo = np.searchsorted(doc, np.arange(b.num_rows + 1))
            spans = pa.StructArray.from_arrays([pa.array(x) for x in (start, length, p)], names=["start", "length", "period"])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.ListArray.from_arrays(pa.array(lo, pa.int32()), spans), texts.cast(pa.string())],
                                             names=["doc_id", "runs", "collapsed"])


def collapse_runs(docs: DataFrame) -> DataFrame:
    """doc_id, runs (array of start, length, period in words) and the text without the repetitions of its runs.

    The words of ``collapsed`` are joined by one space; nulls and empty texts as in ``periodic_runs``.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return rows.mapInArrow(_spans, "doc_id long, runs array<struct<start: long, length: long, period: long>>, collapsed string")
