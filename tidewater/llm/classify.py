"""Steps that the quality and the toxicity classifiers share: held-out rows and bounded training samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import save, text_or_empty

#: Bounds of the training samples (documented parameters): positives and unlabelled rows.
MAX_POSITIVE, MAX_UNLABELLED = 4000, 12000


def remainder(modulus: int) -> Column:
    """crc32 of doc_id as text, mod ``modulus``; null for a null doc_id."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus


def samples(docs: DataFrame, labels: DataFrame, label: str, modulus: int, held: int, name: str,
            max_positive: int = MAX_POSITIVE, max_unlabelled: int = MAX_UNLABELLED) -> DataFrame:
    """(positive boolean, text), stored: positives and unlabelled rows, neither of them held out.

    Ids are taken in the order of a hash, and of the rows that share a doc_id the
    one whose text has the smallest hash, so reruns agree.  The ids of a sample are
    at most ``max_positive + max_unlabelled`` rows, which bounds the broadcast side
    of the join that fetches their texts, and the sample itself.
    """
    def first(df, n):
        ids = df.where(remainder(modulus) != held).select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
        return ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)

    ids = first(labels.where(F.col(label) == 1), max_positive).withColumn("positive", F.lit(True)).unionByName(
        first(docs, max_unlabelled).withColumn("positive", F.lit(False)))
    ids = save(ids.select(F.col("doc_id").alias("__id"), "positive").coalesce(1), f"{name}-ids")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    found = rows.join(F.broadcast(ids), F.col("doc_id") == F.col("__id"))
    one = found.groupBy("doc_id", "positive").agg(F.min_by("text", F.struct(F.xxhash64("text"), F.col("text"))).alias("text"))
    return save(one, f"{name}-sample")


def output(scored: DataFrame, modulus: int, held: int, threshold: float) -> DataFrame:
    """(doc_id, score) -> doc_id, held_out, score, predicted; a null doc_id is not held out."""
    return scored.select("doc_id", F.coalesce(remainder(modulus) == held, F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))
