"""Quality classifier by positive-unlabelled learning over text-shape features.

Trusted positives are rows labelled 1 and not held out; the rest of the corpus
is unlabelled web text.  The features describe the form of a text and no
vocabulary: shares of character classes, word lengths, repetition, line form.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import nnpu
from .classify import MAX_POSITIVE, MAX_UNLABELLED, output, samples
from .common import slices, text_or_empty
from .textstats import run_hashes, runs, text_bytes

MODULUS, HELD, THRESHOLD = 3, 1, 0.5

_CLASSES = ("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", ".", ",", "!?", "|", "#$%&*^~@", "+=<>_\\/{}[]()",
            "'\"-:;`", " \t\r\x0b\x0c", "\n")


def _class_table() -> np.ndarray:
    table = np.full(256, len(_CLASSES) + 1, dtype=np.int8)        # control bytes
    table[0x80:] = len(_CLASSES)
    for i, chars in enumerate(_CLASSES):
        table[[ord(c) for c in chars]] = i
    return table


_TABLE, _K = _class_table(), len(_CLASSES) + 2


def features(texts: pa.Array) -> np.ndarray:
    """One row of shape features per text; the empty text has all zeros but its emptiness."""
    data, off = text_bytes(texts)
    n = len(texts)
    size = np.diff(off)
    doc = np.repeat(np.arange(n), size)
    kinds = _TABLE[data]
    counts = np.bincount(doc * _K + kinds, minlength=n * _K).reshape(n, _K).astype(np.float64)
    space = (kinds == len(_CLASSES) - 2) | (kinds == len(_CLASSES) - 1)
    starts, ends = runs(~space, off)
    of = np.searchsorted(off, starts, side="right") - 1
    words = np.bincount(of, minlength=n).astype(np.float64)
    h = run_hashes(data, starts, ends, ())[0]

    def share(flag, where=None):
        return np.bincount(of if where is None else of[where], weights=flag, minlength=n) / np.maximum(words, 1)

    same = np.zeros(len(h))
    near = np.zeros(len(h))
    if len(h):
        same[1:] = (h[1:] == h[:-1]) & (of[1:] == of[:-1])
        key = np.stack([of.astype(np.uint64), h])
        order = np.lexsort(key[::-1])
        again = (h[order][1:] == h[order][:-1]) & (of[order][1:] == of[order][:-1])
        near[order[1:]] = again
    first, last = kinds[starts] if len(h) else kinds[:0], kinds[ends - 1] if len(h) else kinds[:0]
    lens = (ends - starts).astype(np.float64)
    symbol = np.isin(last, (5, 7, 8))
    caps = np.bincount(of, weights=(first == 1) & (last != 0), minlength=n) / np.maximum(words, 1)
    columns = [counts / np.maximum(size, 1)[:, None], np.log1p(words), np.log1p(size), share(lens) / 10,
               np.sqrt(np.maximum(share(lens**2) - share(lens)**2, 0)) / 10, share(same), share(near), share(symbol), caps,
               share(lens == 1), share(lens > 20), counts[:, len(_CLASSES) - 1] / np.maximum(words, 1), size == 0]
    x = np.column_stack(columns)
    few = 1 / (1 + words)                                        # what shares of few words are worth
    return np.column_stack([x, share(same) * (words >= 8), share(symbol) * (words >= 8), caps * (words >= 8), few]).astype(np.float64)


def train(docs: DataFrame, labels: DataFrame, max_positive: int = MAX_POSITIVE, max_unlabelled: int = MAX_UNLABELLED) -> nnpu.Linear | None:
    """The fitted model; None where there are no positives or no unlabelled rows to learn from."""
    rows = samples(docs, labels, "quality", MODULUS, HELD, "quality", max_positive, max_unlabelled)

    def run(batches):
        for whole in batches:
            for b in slices(whole, "text"):
                x = features(b.column(2))
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(list(x), pa.list_(pa.float64()))],
                                                 names=["doc_id", "positive", "x"])

    got = rows.mapInArrow(run, "doc_id long, positive boolean, x array<double>").orderBy("positive", "doc_id").toPandas()
    if not got["positive"].any() or got["positive"].all():
        return None
    x = np.array(got["x"].tolist())
    p, u = x[got["positive"].to_numpy(dtype=bool)], x[~got["positive"].to_numpy(dtype=bool)]
    return nnpu.fit(p, u, nnpu.estimate_prior(p, u), steps=600)


def score(docs: DataFrame, model: nnpu.Linear | None) -> DataFrame:
    """(doc_id, score) of every whole text; 0.5 throughout without a model."""
    def run(batches):
        for whole in batches:
            for b in slices(whole, "text"):
                s = model.score(features(b.column(1))) if model else np.full(b.num_rows, 0.5)
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(s)], names=["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")).mapInArrow(
        run, "doc_id long, score double")


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for every row.

    Null texts are scored as empty; null labels and labels without a document
    teach nothing; repeated rows are scored alike; an empty table gives an empty
    result; other columns are ignored.
    """
    return output(score(docs, train(docs, labels)), MODULUS, HELD, THRESHOLD)


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows that are not rejected, with the columns of ``docs``."""
    model = train(docs, labels)
    names = docs.columns

    def run(batches):
        for whole in batches:
            for b in slices(whole, "__q_text"):
                good = model.score(features(b.column(len(names)))) >= THRESHOLD if model else np.ones(b.num_rows, dtype=bool)
                yield b.filter(pa.array(good)).select(names)

    return docs.withColumn("__q_text", text_or_empty()).mapInArrow(run, docs.schema)
