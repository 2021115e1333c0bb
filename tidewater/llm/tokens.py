"""Vectorised encoding with a word-separable tokenizer of the tokenizers library.

The word BPE drops white space, folds case and cuts words at the borders of
letters, digits and other characters, so the ids of a text are the ids of those
parts in order.  Each distinct part is encoded once by the library and kept in
a bounded cache of the Python worker; texts become lookups in flat arrays.
Parts of ASCII or accented Latin letters are handed to the library's BPE model
in its byte alphabet, everything else and texts that may hold a special token's
string go through its full pipeline.
"""

from __future__ import annotations

import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .common import list_offsets

TOKENIZER = "word_bpe_49k.json"
#: Letters whose lower case is one character of the same block; no combining marks among them.
_LATIN = "À-ÖØ-öø-įı-ſ"
_PARTS = re.compile(f"[a-z{_LATIN}]+|[0-9]|[^a-z0-9{_LATIN}]+")
_LETTERS = re.compile(f"[a-z{_LATIN}]+")
_ODD = f"[^\\x00-\\x26\\x28-\\x7F{_LATIN}]"       # an apostrophe may belong to letters


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def _byte_alphabet() -> dict[int, str]:
    """Characters of the byte-level alphabet for the Latin letters above: visible bytes stand for
    themselves, the others for the characters from 256 on in order."""
    seen = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    sign = {b: chr(b) for b in seen}
    sign.update({b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in sign)})
    return {c: "".join(sign[b] for b in chr(c).encode()) for c in range(0xC0, 0x180)}


class WordEncoder:
    """ids of whole texts; ``limit`` bounds the parts kept between batches."""

    SEPARATOR = "!"                                # one id, never part of a run of letters

    def __init__(self, path: str, limit: int = 400_000):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers
        self.lib = Tokenizer.from_file(path)
        self.model = Tokenizer.from_file(path)     # the same model behind a bare split at spaces
        self.model.normalizer = None
        self.model.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        self.alphabet = _byte_alphabet()
        self.limit = limit
        sep = self.model.encode(self.SEPARATOR, add_special_tokens=False).ids
        probe = "naïve élan straße the"
        same = [i for w in probe.split() for i in self.model.encode(w.translate(self.alphabet), add_special_tokens=False).ids]
        self.fast = len(sep) == 1 and same == self.lib.encode(probe, add_special_tokens=False).ids
        self.sep = sep[0] if sep else -1
        self._reset()

    def _reset(self):
        self.index: dict[str, int] = {}
        self.flat = np.zeros(1 << 16, dtype=np.uint32)
        self.start = np.zeros(1 << 16, dtype=np.int64)
        self.count = np.zeros(1 << 16, dtype=np.int64)
        self.used = 0

    def _letters(self, parts: list[str]):
        text = f" {self.SEPARATOR} ".join(p if p.isascii() else p.translate(self.alphabet) for p in parts)
        ids = np.array(self.model.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype=np.uint32)
        at = np.flatnonzero(ids == self.sep)
        if len(at) != len(parts) - 1:
            return self._library(parts)
        lo = np.concatenate([[0], at + 1])
        return ids, lo, np.concatenate([at, [len(ids)]]) - lo

    def _library(self, parts: list[str]):
        each = [np.array(e.ids, dtype=np.uint32) for e in self.lib.encode_batch_fast(parts, add_special_tokens=False)]
        counts = np.array([len(e) for e in each], dtype=np.int64)
        return np.concatenate(each), list_offsets(counts)[:-1], counts

    def _learn(self, parts: list[str], encode):
        for lo in range(0, len(parts), 20_000):
            part = parts[lo:lo + 20_000]
            ids, at, counts = encode(part)
            n, k = len(self.index), len(part)
            while n + k > len(self.start):
                self.start = np.concatenate([self.start, np.zeros_like(self.start)])
                self.count = np.concatenate([self.count, np.zeros_like(self.count)])
            while self.used + len(ids) > len(self.flat):
                self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
            self.flat[self.used:self.used + len(ids)] = ids
            self.start[n:n + k] = at + self.used
            self.count[n:n + k] = counts
            self.used += len(ids)
            self.index.update(zip(part, range(n, n + k)))

    def _parts(self, words: pa.Array) -> tuple[list[str], np.ndarray]:
        """Parts of the words in order, and how many each word has."""
        odd = np.asarray(pc.match_substring_regex(words, _ODD)) if self.fast else np.ones(len(words), dtype=bool)
        parts: list[str] = []
        n = np.ones(len(words), dtype=np.int64)
        add, extend, cut = parts.append, parts.extend, _PARTS.findall
        for i, (w, whole) in enumerate(zip(words.to_pylist(), odd.tolist())):
            if whole:
                add(w)
            elif w.isalpha():
                add(w if w.isascii() else w.lower())
            else:
                own = cut(w if w.isascii() else w.lower())
                extend(own)
                n[i] = len(own)
        return parts, n

    def _word_ids(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets) of each word of the array."""
        if len(self.index) > self.limit:
            self._reset()
        parts, n = self._parts(words)
        get = self.index.get
        missing = {p for p in parts if p not in self.index}
        if missing:
            letters = [p for p in missing if self.fast and _LETTERS.fullmatch(p)]
            self._learn(letters, self._letters)
            if len(letters) < len(missing):
                self._learn(list(missing.difference(letters)), self._library)
        at = np.fromiter((get(p) for p in parts), dtype=np.int64, count=len(parts))
        counts = self.count[at]
        ids = _gather(self.flat, self.start[at], counts)
        return ids, list_offsets(counts)[list_offsets(n)]

    def encode(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids uint32, offsets): text i has ids[offsets[i]:offsets[i + 1]], ``end_id`` last."""
        texts = pc.fill_null(texts, "")
        special = np.asarray(pc.match_substring(texts, "<|"))
        clean = texts
        if special.any():
            clean = pc.if_else(pa.array(special), pa.scalar("", texts.type), texts)
        low = pc.ascii_lower(clean)
        for c in "\n\t\r":
            low = pc.replace_substring(low, c, " ")
        lists = pc.split_pattern(low, " ")
        word_off = list_offsets(np.asarray(pc.list_value_length(lists), dtype=np.int64))
        coded = lists.flatten().dictionary_encode()
        own, own_off = self._word_ids(coded.dictionary)
        word = np.asarray(coded.indices)
        counts = np.diff(own_off)[word]
        doc_off = list_offsets(counts)[word_off]
        ids = _gather(own, own_off[:-1][word], counts)
        if special.any():
            return self._with_whole(texts, special, ids, doc_off, end_id)
        n_docs = len(texts)
        out = np.full(len(ids) + n_docs, end_id, dtype=np.uint32)
        plain = np.ones(len(out), dtype=bool)
        plain[doc_off[1:] + np.arange(n_docs)] = False
        out[plain] = ids
        return out, doc_off + np.arange(n_docs + 1)

    def _with_whole(self, texts, special, ids, doc_off, end_id):
        whole = iter(self.lib.encode_batch(texts.filter(pa.array(special)).to_pylist(), add_special_tokens=False))
        parts = []
        for i, odd in enumerate(special):
            own = np.array(next(whole).ids, dtype=np.uint32) if odd else ids[doc_off[i]:doc_off[i + 1]]
            parts.append(np.append(own, np.uint32(end_id)))
        return np.concatenate(parts).astype(np.uint32), list_offsets(np.array([len(p) for p in parts], dtype=np.int64))


def _gather(flat: np.ndarray, start: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Concatenated runs flat[start:start + count]."""
    ends = np.cumsum(counts)
    take = np.repeat(start - (ends - counts), counts)
    take += np.arange(len(take))
    return flat[take]


_ENCODERS: dict[tuple[str, int], WordEncoder] = {}


def encoder(path: str, limit: int = 400_000) -> WordEncoder:
    """One encoder per Python worker, so its cache (of about ``limit`` parts) serves all tasks of that worker."""
    if (path, limit) not in _ENCODERS:
        _ENCODERS[path, limit] = WordEncoder(path, limit)
    return _ENCODERS[path, limit]
