"""Words of whole texts as dictionary ids, without a Python loop over words."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from .textstats import runs, text_bytes

#: A word byte is anything but ASCII white space: the pattern [^\x20\x09-\x0D]+ over UTF-8.
_WORD_BYTE = np.ones(256, dtype=bool)
_WORD_BYTE[[0x20, *range(0x09, 0x0E)]] = False


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(all words in order, offsets): text i has words[offsets[i]:offsets[i + 1]]; null counts as empty."""
    data, off = text_bytes(texts)
    member = _WORD_BYTE[data]
    starts, ends = runs(member, off)
    bounds = np.zeros(len(starts) + 1, dtype=np.int64)
    np.cumsum(ends - starts, out=bounds[1:])
    words = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(bounds), pa.py_buffer(data[member]))
    return words, np.searchsorted(starts, off)


def word_ids(texts: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """(id of each word in order, the distinct words, offsets of the texts)."""
    words, off = split_words(texts)
    coded = words.dictionary_encode()
    return np.asarray(coded.indices).astype(np.int64), coded.dictionary, off
