"""Toxicity by non-negative positive-unlabelled learning over word features.

Confirmed toxic rows (label 1, not held out) are the positives, the corpus is
unlabelled.  A word is a run of letters with A-Z in lower case; it and its
beginnings of ``PREFIXES`` bytes are known by their hashes, so unseen forms of a
known word count.  A first pass over the training sample counts in how many texts
each occurs; all that at least two positives and a share of ``SHARE`` of them hold, ``LIFT`` times
the share of the corpus, are features of the model, whose weights are kept small
by a penalty.  Texts are sparse rows throughout.
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

MODULUS, HELD, THRESHOLD = 4, 2, 0.3
BUCKETS, PREFIXES, SHARE, LIFT = 1 << 20, (4, 5, 6), 0.02, 4
PENALTY, PRIOR_PENALTY = 3e-3, 0.1


def buckets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(text, bucket) of every word and word beginning, repeats included."""
    data, off = text_bytes(texts)
    upper = (data >= 65) & (data <= 90)
    low = np.where(upper, data + 32, data).astype(np.uint8)
    letter = ((low >= 97) & (low <= 122)) | (low >= 0x80)
    starts, ends = runs(letter, off)
    of = np.searchsorted(off, starts, side="right") - 1
    hashes = run_hashes(low, starts, ends, PREFIXES)
    return np.tile(of, len(hashes)), (np.concatenate(hashes) >> np.uint64(44)).astype(np.int64)


def _distinct(of: np.ndarray, bucket: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    key = np.unique(of * BUCKETS + bucket)
    return key // BUCKETS, key % BUCKETS


def _frequencies(batches):
    for whole in batches:
        for b in slices(whole, "text"):
            of, bucket = _distinct(*buckets(b.column(2)))
            positive = np.asarray(b.column(1).to_numpy(zero_copy_only=False), dtype=bool)[of]
            both = [np.bincount(bucket[flag], minlength=BUCKETS) for flag in (positive, ~positive)]
            seen = np.flatnonzero(both[0])                       # what no positive holds is never chosen
            yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(both[0][seen]), pa.array(both[1][seen])],
                                             names=["bucket", "p", "u"])


class Model:
    def __init__(self, chosen: np.ndarray, linear: nnpu.Linear):
        self.slot = np.full(BUCKETS, -1, dtype=np.int32)
        self.slot[chosen] = np.arange(len(chosen))
        self.linear = linear

    def score(self, texts: pa.Array) -> np.ndarray:
        return self.linear.score(present(texts, self.slot, len(self.linear.weight)))


def present(texts: pa.Array, slot: np.ndarray, size: int) -> nnpu.Rows:
    """The features that each text holds."""
    of, bucket = buckets(texts)
    at = slot[bucket]
    key = np.unique(of[at >= 0] * size + at[at >= 0])
    return nnpu.Rows(key % size, np.searchsorted(key // size, np.arange(len(texts) + 1)), size)


def train(docs: DataFrame, labels: DataFrame, max_positive: int = MAX_POSITIVE, max_unlabelled: int = MAX_UNLABELLED) -> Model | None:
    """The fitted model; None where there are no positives or no unlabelled rows to learn from."""
    rows = samples(docs, labels, "toxic", MODULUS, HELD, "toxic", max_positive, max_unlabelled)
    sizes = {r["positive"]: r["n"] for r in rows.groupBy("positive").agg(F.count(F.lit(1)).alias("n")).collect()}
    n_p, n_u = sizes.get(True, 0), sizes.get(False, 0)
    if not n_p or not n_u:
        return None
    df = rows.mapInArrow(_frequencies, "bucket long, p long, u long").groupBy("bucket").agg(F.sum("p").alias("p"), F.sum("u").alias("u"))
    best = df.where((F.col("p") >= max(2, SHARE * n_p)) & (F.col("p") / n_p > LIFT * F.col("u") / n_u)).select("bucket").collect()     # at most BUCKETS
    if not best:
        return None
    chosen = np.sort(np.array([r["bucket"] for r in best], dtype=np.int64))
    slot = np.full(BUCKETS, -1, dtype=np.int32)
    slot[chosen] = np.arange(len(chosen))

    def run(batches):
        for whole in batches:
            for b in slices(whole, "text"):
                x = present(b.column(2), slot, len(chosen))
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.ListArray.from_arrays(pa.array(x.offsets, pa.int32()), pa.array(x.columns, pa.int64()))],
                                                 names=["doc_id", "positive", "x"])

    got = rows.mapInArrow(run, "doc_id long, positive boolean, x array<long>").orderBy("positive", "doc_id").toPandas()
    off = np.concatenate([[0], np.cumsum([len(v) for v in got["x"]])]).astype(np.int64)
    x = nnpu.Rows(np.concatenate([np.zeros(0, dtype=np.int64), *got["x"]]).astype(np.int64), off, len(chosen))
    flag = got["positive"].to_numpy(dtype=bool)
    p, u = x.take(np.flatnonzero(flag)), x.take(np.flatnonzero(~flag))
    prior = nnpu.estimate_prior(p, u, centre=False, l2=PRIOR_PENALTY)
    return Model(chosen, nnpu.fit(p, u, prior, steps=500, centre=False, l2=PENALTY))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for every row.

    Null texts are scored as empty; null labels and labels without a document
    teach nothing; without positives every score is 0; repeated rows are scored
    alike; an empty table gives an empty result; other columns are ignored.
    """
    model = train(docs, labels)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for whole in batches:
            for b in slices(whole, "text"):
                s = shared.value.score(b.column(1)).astype(np.float64) if shared.value else np.zeros(b.num_rows)
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(s)], names=["doc_id", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return output(rows.mapInArrow(run, "doc_id long, score double"), MODULUS, HELD, THRESHOLD)
