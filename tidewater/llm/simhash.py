"""SimHash near-duplicates by anchor-point covering.

Fingerprints of 64 bits are compared through anchors: the codewords of a
covering code.  The code is the product of two perfect binary Golay codes
[23, 12] (covering radius 3 each) on bits 0-22 and 23-45; the other bits take no
part in the keys, only in the comparison.  A fingerprint lives at the anchor
nearest to it and is replicated to every anchor within covering radius plus the
bits that may differ, the two halves sharing those bits.  Two fingerprints
within the threshold therefore meet at the home anchor of either one; each pair
is compared where the smaller anchor is home.  2**24 anchors keep the number of
fingerprints per anchor small: about 30 replicas a fingerprint, no sampling and
no cap.

Only distinct fingerprints are compared, so a group of copies counts once.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import located, save, slices, text_or_empty, without_rows
from .components import components

SHINGLE, MAX_BITS, SEED = 3, 2, 42
BLOCK, RADIUS = 23, 3
#: Fixed value: generator polynomial of the binary Golay code.
GOLAY = 0b101011100011


# --- fingerprints -------------------------------------------------------------------------

def _shingle_bounds(data: np.ndarray, text_off: np.ndarray, width: int):
    """Clean words of concatenated texts: (bytes of words joined by one space, starts, ends, shingles per text).

    Shingle i of the batch is clean[starts[i]:ends[i]].
    """
    space = (data == 0x20) | ((data >= 0x09) & (data <= 0x0D))
    border = np.zeros(len(data) + 1, dtype=bool)
    border[text_off[:-1]] = True
    inside = ~space
    before = np.concatenate([[False], inside[:-1]])
    first = inside & (~before | border[:-1])
    starts = np.flatnonzero(first)
    after = np.concatenate([inside[1:], [False]])
    last = inside & (~after | border[1:])
    ends = np.flatnonzero(last) + 1
    lens = ends - starts
    clean_end = np.cumsum(lens + 1) - 1                   # one space after each word
    clean_start = clean_end - lens
    clean = np.full(int(clean_end[-1]) + 1 if len(lens) else 0, 0x20, dtype=np.uint8)
    clean[np.arange(int(lens.sum())) + np.repeat(np.arange(len(lens)), lens)] = data[inside]
    n_words = np.diff(np.searchsorted(starts, text_off))
    n_sh = np.where(n_words >= width, n_words - width + 1, np.minimum(n_words, 1))
    first_word = np.cumsum(n_words) - n_words
    total = int(n_sh.sum())
    at = np.repeat(first_word - (np.cumsum(n_sh) - n_sh), n_sh) + np.arange(total)
    span = np.repeat(np.minimum(n_words, width), n_sh)
    return clean, clean_start[at], clean_end[at + span - 1], n_sh


def fingerprints_of(texts: pa.Array, width: int = SHINGLE, seed: int = SEED, chunk: int = 1 << 18) -> np.ndarray:
    """64-bit fingerprints (uint64) of a string array; see ``fingerprints``."""
    import xxhash
    texts = pc.cast(pc.ascii_lower(pc.fill_null(texts, "")), pa.large_string())
    bufs = texts.buffers()
    off = np.frombuffer(bufs[1], dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(bufs[2], dtype=np.uint8)[off[0]:off[-1]] if bufs[2] else np.zeros(0, np.uint8)
    clean, lo, hi, n_sh = _shingle_bounds(data, off - off[0], width)
    raw, digest = clean.tobytes(), xxhash.xxh64_intdigest
    counts = np.zeros((len(texts), 64), dtype=np.int64)
    doc = np.repeat(np.arange(len(texts)), n_sh)
    for a in range(0, len(lo), chunk):
        part = slice(a, a + chunk)
        h = np.fromiter((digest(raw[x:y], seed) for x, y in zip(lo[part].tolist(), hi[part].tolist())),
                        dtype=np.uint64, count=len(lo[part]))
        bits = np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        own, first = np.unique(doc[part], return_index=True)
        counts[own] += np.add.reduceat(bits, first, axis=0, dtype=np.int64)
    ones = (2 * counts > n_sh[:, None]).astype(np.uint8)
    return np.packbits(ones, axis=1, bitorder="little").view("<u8").ravel().astype(np.uint64)


def fingerprints(docs: DataFrame, width: int = SHINGLE, seed: int = SEED, *kept: str) -> DataFrame:
    """(doc_id, the long columns ``kept``, fp): a bit of fp (long, same 64 bits) is 1 if set in over half the XXH64 hashes of the word
    shingles of the text with A-Z in lower case; fewer words than ``width`` form one shingle, no words give 0."""
    def run(batches):
        for whole in batches:
            for b in slices(whole, "text"):
                n = b.num_columns - 1
                fp = pa.array(fingerprints_of(b.column(n), width, seed).view(np.int64))
                yield pa.RecordBatch.from_arrays([*b.columns[:n], fp], names=[*names, "fp"])

    names = ["doc_id", *kept]
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), *kept, text_or_empty().alias("text")).mapInArrow(
        run, ", ".join(f"{n} long" for n in [*names, "fp"]))


# --- covering code ------------------------------------------------------------------------

def golay_decoder() -> np.ndarray:
    """Index of the one codeword within distance 3 of each 23-bit word (perfect code)."""
    messages = np.arange(1 << 12, dtype=np.int64)
    words = np.zeros(1 << 12, dtype=np.int64)
    for i in range(12):
        words ^= np.where(messages >> i & 1, GOLAY << i, 0)
    one = [1 << i for i in range(BLOCK)]
    errors = [0, *one] + [a | b for i, a in enumerate(one) for b in one[:i]] + [
        a | b | c for i, a in enumerate(one) for j, b in enumerate(one[:i]) for c in one[:j]]
    table = np.full(1 << BLOCK, -1, dtype=np.int16)
    for e in errors:
        table[words ^ e] = messages
    assert (table >= 0).all()
    return table


_TABLE: list[np.ndarray] = []


def _flips(bits: int) -> list[np.ndarray]:
    one = np.array([1 << i for i in range(BLOCK)], dtype=np.int64)
    levels = [np.zeros(1, dtype=np.int64)]
    for _ in range(bits):
        levels.append(np.unique((levels[-1][:, None] | one[None, :]).ravel()))
    return levels


def _reach(words: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, anchor, cost): every anchor within RADIUS + cost of each word, cost <= bits, each once at its least cost."""
    if not _TABLE:
        _TABLE.append(golay_decoder())
    table, rows, anchors, costs = _TABLE[0], [], [], []
    for cost, flips in enumerate(_flips(bits)):
        found = np.sort(table[words[:, None] ^ flips[None, :]], axis=1)
        new = np.ones(found.shape, dtype=bool)
        new[:, 1:] = found[:, 1:] != found[:, :-1]
        r, c = np.nonzero(new)
        rows.append(r)
        anchors.append(found[r, c].astype(np.int64))
        costs.append(np.full(len(r), cost))
    r, a, c = np.concatenate(rows), np.concatenate(anchors), np.concatenate(costs)
    key = r * (1 << 12) + a
    order = np.lexsort((c, key))
    first = np.ones(len(key), dtype=bool)
    first[1:] = key[order][1:] != key[order][:-1]
    keep = order[first]
    return r[keep], a[keep], c[keep]


def anchors_of(fps: np.ndarray, bits: int = MAX_BITS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, anchor, home): the anchors of each fingerprint that are not below its home anchor; home marks that one."""
    mask = (1 << BLOCK) - 1
    x = fps.view(np.int64) if fps.dtype == np.uint64 else fps
    ra, aa, ca = _reach(x & mask, bits)
    rb, ab, cb = _reach(x >> BLOCK & mask, bits)
    n = len(x)
    na, nb = np.bincount(ra, minlength=n), np.bincount(rb, minlength=n)
    pairs = na * nb
    row = np.repeat(np.arange(n), pairs)
    inner = np.arange(int(pairs.sum())) - np.repeat(np.cumsum(pairs) - pairs, pairs)
    i = (np.cumsum(na) - na)[row] + inner // nb[row]
    j = (np.cumsum(nb) - nb)[row] + inner % nb[row]
    near = ca[i] + cb[j] <= bits
    row, i, j = row[near], i[near], j[near]
    anchor = aa[i] << 12 | ab[j]
    at_home = ca[i] + cb[j] == 0
    home = np.zeros(n, dtype=np.int64)
    home[row[at_home]] = anchor[at_home]
    keep = anchor >= home[row]
    return row[keep], anchor[keep], at_home[keep]


def links(fps: DataFrame, bits: int = MAX_BITS) -> DataFrame:
    """(u, v), u < v once each: distinct fingerprints of ``fps`` (fp long) that differ in at most ``bits`` bits."""
    if bits > 2 * RADIUS:
        raise ValueError("the anchors' halves decode at most six differing bits")

    def run(batches):
        for b in batches:
            for lo in range(0, b.num_rows, 2048):
                x = np.asarray(b.column(0).slice(lo, 2048))
                row, anchor, home = anchors_of(x, bits)
                yield pa.RecordBatch.from_arrays([pa.array(anchor), pa.array(x[row]), pa.array(home)],
                                                 names=["anchor", "fp", "home"])

    spread = fps.select("fp").mapInArrow(run, "anchor long, fp long, home boolean")
    homes = fps.select("fp").mapInArrow(
        lambda batches: (b.filter(b.column(2)) for b in run(batches)), "anchor long, fp long, home boolean")
    probe = spread.select("anchor", F.col("fp").alias("x"), "home").hint("merge")   # far larger than its estimate
    near = F.bit_count(F.col("x").bitwiseXOR(F.col("y"))) <= bits
    return (probe.join(homes.select("anchor", F.col("fp").alias("y")), "anchor")
            .where(near & (~F.col("home") | (F.col("x") < F.col("y"))))
            .select(F.least("x", "y").alias("u"), F.greatest("x", "y").alias("v")))


# --- the job ------------------------------------------------------------------------------

def classes(fp: DataFrame, bits: int = MAX_BITS) -> DataFrame:
    """(fp, component): the smallest fingerprint that each stored fingerprint reaches by links."""
    distinct = save(fp.select("fp").distinct(), "simhash-distinct")
    member = components(links(distinct, bits))
    return distinct.join(member, distinct["fp"] == member["node"], "left").select("fp", F.coalesce("component", "fp").alias("component"))


def groups(docs: DataFrame, width: int = SHINGLE, bits: int = MAX_BITS) -> DataFrame:
    """doc_id, fp, component_id for every row.

    component_id is the smallest doc_id reachable by links.  Null texts count as
    empty, whose fingerprint 0 links like any other; equal fingerprints always
    link; a null doc_id never names a component that holds another id; an empty
    table gives an empty result; other columns are ignored.
    """
    fp = save(fingerprints(docs, width), "simhash")
    named = save(fp.groupBy("fp").agg(F.min("doc_id").alias("low")).join(classes(fp, bits), "fp"), "simhash-members")
    low = named.groupBy("component").agg(F.min("low").alias("component_id"))
    ids = named.join(low, "component").select("fp", "component_id")
    return fp.join(ids, "fp").select("doc_id", "fp", "component_id")


def near_duplicates(docs: DataFrame, width: int = SHINGLE, bits: int = MAX_BITS) -> DataFrame:
    """doc_id, fingerprint (16 lowercase hex digits), component_id; see ``groups``."""
    return groups(docs, width, bits).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def drop_near_duplicates(docs: DataFrame, width: int = SHINGLE, bits: int = MAX_BITS) -> DataFrame:
    """One document of each group (its smallest doc_id; one row of it if rows repeat), with the columns of ``docs``."""
    key = ("__tw_file", "__tw_row")
    rows = located(docs)
    fp = save(fingerprints(rows, width, SEED, *key), "simhash")
    # first row of each fingerprint, then of each class: null doc_ids last, then by doc_id and place
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", *key))
    best = fp.groupBy("fp").agg(first.alias("best")).join(classes(fp, bits), "fp")
    best = save(best.groupBy("component").agg(F.min("best").alias("best")).select("best.*"), "simhash-kept")
    return without_rows(rows, fp.join(best.select(*key).hint("merge"), list(key), "left_anti")).select(*[f"`{c}`" for c in docs.columns])
