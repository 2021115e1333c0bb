"""Vectorised statistics over the bytes of a batch of texts (numpy only, no loop over words)."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string array, null as empty."""
    texts = pc.cast(pc.fill_null(texts, ""), pa.large_string())
    bufs = texts.buffers()
    off = np.frombuffer(bufs[1], dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(bufs[2], dtype=np.uint8)[off[0]:off[-1]] if bufs[2] else np.zeros(0, np.uint8)
    return data, off - off[0]


def runs(member: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(starts, ends) of maximal runs of member bytes; no run crosses a text border."""
    border = np.zeros(len(member) + 1, dtype=bool)
    border[off] = True
    before = np.concatenate([[False], member[:-1]])
    after = np.concatenate([member[1:], [False]])
    return np.flatnonzero(member & (~before | border[:-1])), np.flatnonzero(member & (~after | border[1:])) + 1


_MULT = np.random.default_rng(7).integers(1, 2**63, size=64, dtype=np.uint64) | np.uint64(1)
_SIGN = np.random.default_rng(11).integers(1, 2**63, size=256, dtype=np.uint64)


def run_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, prefixes: tuple[int, ...]) -> list[np.ndarray]:
    """uint64 hash of each run, and of its first p bytes for each p (of the whole run where it is shorter)."""
    lens = ends - starts
    total = int(lens.sum())
    pos = np.arange(total) - np.repeat(np.cumsum(lens) - lens, lens)
    member = data[np.repeat(starts, lens) + pos]
    at = np.cumsum(lens) - lens
    mixed = _SIGN[member] * _MULT[pos & 63] ^ (pos >> 6).astype(np.uint64)
    out = []
    for p in (*prefixes, None):
        part = mixed if p is None else np.where(pos < p, mixed, np.uint64(0))
        h = np.add.reduceat(part, at) if total else np.zeros(0, np.uint64)
        h ^= h >> np.uint64(31)
        out.append(h * np.uint64(0x9E3779B97F4A7C15) + np.uint64(0 if p is None else p))
    return out
