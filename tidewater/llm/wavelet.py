"""Token ids in succinct shard files: one wavelet matrix per shard.

Documents are range-partitioned and sorted by doc_id.  Each task encodes its
range and closes a shard at the first document end after ``shard_ids`` ids, so
memory is bounded by a shard, 16 MB of text and the longest document.  A shard file is one
byte string (format below) stored as one row of a table in the shared folder:
Spark's commit protocol then makes each file appear once, whole, on any store.

Shard file, little endian:
    magic b"TWWM" | version u32 | n_ids u64 | planes u32 | block_bits u32 | n_docs u64 | n_tables u64 (byte length)
    zstd frame of the tables: doc_id i64[n_docs], doc_id null flags u8[n_docs], ids per document i64[n_docs],
        zeros u64[planes], ones before each block u64[planes * n_blocks], block ends u64[planes * n_blocks]
    bit-plane blocks, each one zstd frame of packed bits (first bit in the high position)

Plane 0 holds the highest bit.  A reader opens the tables and unpacks only the
blocks that a question touches: ``access``, ``rank``, ``count``, ``select`` and
``decode`` need no other file.
"""

from __future__ import annotations

import struct
import zlib
from collections import OrderedDict

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import list_offsets, save, slices, text_or_empty
from .tokens import encoder, tokenizer_path

MAGIC, VERSION, BLOCK_BITS, SHARD_IDS = b"TWWM", 1, 1 << 16, 1 << 20
#: Text encoded at once (a word is looked up once in it) and parts of words a worker remembers.
ENCODED_BYTES, KEPT_PARTS = 16 << 20, 500_000
_HEAD = struct.Struct("<4sIQIIQQ")


def build(ids: np.ndarray, doc_ids: np.ndarray, doc_null: np.ndarray, doc_n: np.ndarray, planes: int,
          block_bits: int = BLOCK_BITS) -> bytes:
    """The shard file of ``ids`` (all below 2 ** planes)."""
    import zstandard
    press = zstandard.ZstdCompressor(level=1)
    seq = ids.astype(np.uint16 if planes <= 16 else np.uint32)
    n = len(seq)
    n_blocks = -(-n // block_bits)
    zeros, before, ends, blocks, at = [], [], [], [], 0
    for p in range(planes):
        bit = (seq & seq.dtype.type(1 << (planes - 1 - p))) != 0
        packed = np.packbits(bit)
        ones = np.add.reduceat(np.bitwise_count(packed).astype(np.int64), np.arange(0, len(packed), block_bits // 8)) if n else np.zeros(0, np.int64)
        before.append(list_offsets(ones)[:-1])
        for b in range(n_blocks):
            block = press.compress(packed[b * block_bits // 8:(b + 1) * block_bits // 8].tobytes())
            blocks.append(block)
            at += len(block)
            ends.append(at)
        left = seq.take(np.flatnonzero(~bit))              # by places: far faster than by a mask of random bits
        zeros.append(len(left))
        seq = np.concatenate([left, seq.take(np.flatnonzero(bit))])
    tables = b"".join([doc_ids.astype("<i8").tobytes(), doc_null.astype("u1").tobytes(), doc_n.astype("<i8").tobytes(),
                       np.array(zeros, dtype="<u8").tobytes(),
                       np.concatenate(before).astype("<u8").tobytes() if before else b"",
                       np.array(ends, dtype="<u8").tobytes()])
    small = press.compress(tables)
    return _HEAD.pack(MAGIC, VERSION, n, planes, block_bits, len(doc_ids), len(small)) + small + b"".join(blocks)


class Shard:
    """Reader of one shard file; ``kept_blocks`` bounds the unpacked blocks in memory."""

    def __init__(self, data: bytes, kept_blocks: int = 64):
        import zstandard
        self._plain = zstandard.ZstdDecompressor()
        magic, version, self.n, self.planes, self.block_bits, n_docs, size = _HEAD.unpack_from(data)
        if magic != MAGIC or version != VERSION:
            raise ValueError("not a shard file of this version")
        t = self._plain.decompress(data[_HEAD.size:_HEAD.size + size])
        self.n_blocks = -(-self.n // self.block_bits)
        at = 0

        def take(kind, count):
            nonlocal at
            out = np.frombuffer(t, dtype=kind, count=count, offset=at)
            at += out.nbytes
            return out

        self.doc_ids, self.doc_null, self.doc_n = take("<i8", n_docs), take("u1", n_docs), take("<i8", n_docs)
        self.zeros = take("<u8", self.planes).astype(np.int64)
        shape = (self.planes, self.n_blocks)
        self.before = take("<u8", self.planes * self.n_blocks).astype(np.int64).reshape(shape)
        self.ends = take("<u8", self.planes * self.n_blocks).astype(np.int64)
        self.data, self.base = data, _HEAD.size + size
        self._kept: OrderedDict = OrderedDict()
        self._max = kept_blocks

    def _unpack(self, plane: int, block: int) -> np.ndarray:
        i = plane * self.n_blocks + block
        lo = int(self.ends[i - 1]) if i else 0
        raw = self._plain.decompress(self.data[self.base + lo:self.base + int(self.ends[i])])
        return np.unpackbits(np.frombuffer(raw, dtype=np.uint8),
                             count=min(self.block_bits, self.n - block * self.block_bits))

    def _block(self, plane: int, block: int) -> tuple[np.ndarray, np.ndarray]:
        key = (plane, block)
        if key not in self._kept:
            bits = self._unpack(plane, block)
            self._kept[key] = (bits, list_offsets(bits))
            if len(self._kept) > self._max:
                self._kept.popitem(last=False)
        self._kept.move_to_end(key)
        return self._kept[key]

    def _bit(self, plane: int, i: int) -> int:
        return int(self._block(plane, i // self.block_bits)[0][i % self.block_bits])

    def _ones(self, plane: int, i: int) -> int:
        """Ones among the first i bits of a plane."""
        if i >= self.n:
            return self.n - int(self.zeros[plane])
        b = i // self.block_bits
        return int(self.before[plane, b]) + int(self._block(plane, b)[1][i % self.block_bits])

    def _nth(self, plane: int, k: int, one: int) -> int:
        """Position of the k-th (from 0) one or zero of a plane."""
        before = self.before[plane]
        if not one:
            before = np.arange(self.n_blocks) * self.block_bits - before
        b = int(np.searchsorted(before, k, side="right")) - 1
        bits = self._block(plane, b)[0]
        return b * self.block_bits + int(np.flatnonzero(bits == one)[k - int(before[b])])

    def access(self, i: int) -> int:
        """The i-th id of the shard."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        value = 0
        for p in range(self.planes):
            bit = self._bit(p, i)
            ones = self._ones(p, i)
            value = value * 2 + bit
            i = int(self.zeros[p]) + ones if bit else i - ones
        return value

    def _range(self, token: int, lo: int, hi: int) -> tuple[int, int]:
        if token >> self.planes:
            return 0, 0
        for p in range(self.planes):
            a, b = self._ones(p, lo), self._ones(p, hi)
            if token >> (self.planes - 1 - p) & 1:
                lo, hi = int(self.zeros[p]) + a, int(self.zeros[p]) + b
            else:
                lo, hi = lo - a, hi - b
            if lo >= hi:
                return lo, lo
        return lo, hi

    def rank(self, token: int, i: int) -> int:
        """Occurrences of ``token`` among the first i ids."""
        lo, hi = self._range(token, 0, min(i, self.n))
        return hi - lo

    def count(self, token: int, lo: int = 0, hi: int | None = None) -> int:
        a, b = self._range(token, lo, self.n if hi is None else min(hi, self.n))
        return b - a

    def select(self, token: int, k: int) -> int:
        """Position of the k-th (from 0) occurrence of ``token``; -1 if there are fewer."""
        lo, hi = self._range(token, 0, self.n)
        if not 0 <= k < hi - lo:
            return -1
        i = lo + k
        for p in reversed(range(self.planes)):
            one = token >> (self.planes - 1 - p) & 1
            i = self._nth(p, i - int(self.zeros[p]) if one else i, one)
        return i

    def decode(self) -> np.ndarray:
        """All ids, from the lowest plane upward."""
        seq = np.zeros(self.n, dtype=np.uint16 if self.planes <= 16 else np.uint32)
        for p in reversed(range(self.planes)):
            bits = [self._unpack(p, b) for b in range(self.n_blocks)]
            bit = np.concatenate(bits).view(bool) if bits else np.zeros(0, dtype=bool)
            z = int(self.zeros[p])
            up = np.empty_like(seq)
            up[np.flatnonzero(~bit)] = seq[:z]
            up[np.flatnonzero(bit)] = seq[z:] | seq.dtype.type(1 << (self.planes - 1 - p))
            seq = up
        return seq.astype(np.uint32)


# --- the job ------------------------------------------------------------------------------

def write_shards(docs: DataFrame, tokenizer: str | None = None, end_id: int = 2, shard_ids: int = SHARD_IDS,
                 partitions: int | None = None) -> DataFrame:
    """Shard files as a stored table (part, shard, n_docs, n_ids, file), in ascending doc_id over (part, shard)."""
    spark = docs.sparkSession
    path = tokenizer or tokenizer_path()

    def run(batches):
        part, shard = TaskContext.get().partitionId(), 0
        enc = encoder(path, KEPT_PARTS)
        planes = max(1, int(max(enc.lib.get_vocab_size(with_added_tokens=True) - 1, end_id)).bit_length())
        held, n_held = [], 0

        def close():
            ids = np.concatenate([h[0] for h in held])
            doc = pa.chunked_array([h[1] for h in held])
            null = np.asarray(doc.is_null())
            blob = build(ids, np.asarray(pa.compute.fill_null(doc, 0)), null, np.concatenate([h[2] for h in held]), planes)
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([shard], pa.int32()), pa.array([len(doc)], pa.int64()),
                 pa.array([len(ids)], pa.int64()), pa.array([blob], pa.binary())],
                names=["part", "shard", "n_docs", "n_ids", "file"])

        for whole in batches:
            for batch in slices(whole, "text", ENCODED_BYTES):
                ids, off = enc.encode(batch.column(1), end_id)
                lo = 0
                while lo < batch.num_rows:
                    hi = int(np.searchsorted(off, off[lo] + shard_ids - n_held, side="left"))
                    hi = min(max(hi, lo + 1), batch.num_rows)
                    held.append((ids[off[lo]:off[hi]], batch.column(0).slice(lo, hi - lo), np.diff(off[lo:hi + 1])))
                    n_held += int(off[hi] - off[lo])
                    lo = hi
                    if n_held >= shard_ids:
                        yield close()
                        held, n_held, shard = [], 0, shard + 1
        if held:
            yield close()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.repartitionByRange(n, "doc_id").sortWithinPartitions("doc_id", F.xxhash64("text"))
    return save(ordered.mapInArrow(run, "part int, shard int, n_docs long, n_ids long, file binary"), "wavelet-shards")


def read_shards(shards: DataFrame) -> DataFrame:
    """Per document, from the shard files alone: doc_id, start, n_tokens, ids_crc32.

    start counts the ids of all documents before it: a window over the shards of
    a part and one over the parts, both tables of one row per file or part.
    """
    sizes = shards.select("part", "shard", "n_ids")
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = (sizes.groupBy("part").agg(F.sum("n_ids").alias("n"))
             .select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("part_start")))
    inside = Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    starts = (sizes.withColumn("in_part", F.coalesce(F.sum("n_ids").over(inside), F.lit(0))).join(parts, "part")
              .select("part", "shard", (F.col("part_start") + F.col("in_part")).alias("first_id")))

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                s = Shard(batch.column(2)[i].as_py())
                ids = memoryview(s.decode().astype("<u4", copy=False)).cast("B")
                off = list_offsets(s.doc_n)
                ends = (off * 4).tolist()
                crc = np.fromiter((zlib.crc32(ids[a:b]) for a, b in zip(ends, ends[1:])), dtype=np.int64, count=len(ends) - 1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([batch.column(0)[i].as_py()] * len(crc), pa.int32()),
                     pa.array([batch.column(1)[i].as_py()] * len(crc), pa.int32()),
                     pa.array(s.doc_ids, pa.int64(), mask=s.doc_null.astype(bool)),
                     pa.array(off[:-1]), pa.array(s.doc_n, pa.int64()), pa.array(crc)],
                    names=["part", "shard", "doc_id", "local", "n_tokens", "ids_crc32"])

    docs = shards.select("part", "shard", "file").mapInArrow(
        run, "part int, shard int, doc_id long, local long, n_tokens long, ids_crc32 long")
    return docs.join(starts, ["part", "shard"]).select(
        "doc_id", (F.col("first_id") + F.col("local")).alias("start"), "n_tokens", "ids_crc32")


def token_shards(docs: DataFrame, tokenizer: str | None = None, end_id: int = 2) -> DataFrame:
    """Encode, write, read back: (doc_id, start, n_tokens, ids_crc32).

    Null texts count as empty (the end id alone); null doc_ids come first;
    equal doc_ids follow each other by a hash of the text; an empty table gives
    an empty result; other columns are ignored.
    """
    return read_shards(write_shards(docs, tokenizer, end_id))
