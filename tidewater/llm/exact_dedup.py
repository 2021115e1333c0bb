"""Exact deduplication with keyed streaming state.

Every row arrives as (digest, doc_id, content locator).  A streaming aggregation
keyed by digest holds, in RocksDB state below the checkpoint folder and without
any expiry, the row that stays (largest doc_id, then largest locator), its
locator and the number of rows seen.  Texts never enter the state.  On a hit
the full bytes are compared with the text at the kept locator; texts that share
a digest and differ are grouped again by the text itself.

Later arrivals continue from the same state folder: pass the same ``folder``.  The
folder also lists the files of every arrival, and the text that an earlier arrival kept is
read from there by its locator and compared with the full bytes of a hit.  If such a
file is gone or changed, the run fails instead of trusting the digest.
Only DataFrame operations run on the executors.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.session import children, scratch_path

from .common import located, maybe_among, save, text_or_empty, without_rows

_STATE = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",   # no room held in advance for each state partition
}


def _digest(df: DataFrame) -> DataFrame:
    return df.withColumn("__tw_digest", F.unhex(F.sha2(F.encode(text_or_empty(), "UTF-8"), 256)))


def run_state(arrivals_path: str, schema, folder: str, spark) -> None:
    """Feed stored arrivals through the keyed state; changed keys of each micro-batch go to ``folder``/groups."""
    arrivals = spark.readStream.schema(schema).parquet(arrivals_path)
    groups = arrivals.groupBy("__tw_digest").agg(
        F.max(F.struct("doc_id", "__tw_file", "__tw_row")).alias("keeper"), F.count(F.lit(1)).alias("group_size"))

    def store(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/groups/batch={number}")

    before = {k: spark.conf.get(k, None) for k in _STATE}
    try:
        for k, v in _STATE.items():
            spark.conf.set(k, v)
        (groups.writeStream.outputMode("update").foreachBatch(store)
         .option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start().awaitTermination())
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def decide(docs: DataFrame, folder: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(decisions, located documents).

    decisions has one row per document row: doc_id, keep_id, group_size, kept,
    __tw_digest, __tw_file, __tw_row.  Null texts equal the empty text; a null doc_id is the
    smallest; of rows with equal doc_id and text the one with the largest
    locator stays; an empty table gives an empty result; other columns are ignored.
    With a ``folder`` of earlier arrivals the groups reach over all of them: decisions are issued for the rows
    of ``docs`` alone, and an earlier row whose group now keeps a larger doc_id is not issued again.  Every
    arrival has to come from files of its own.
    """
    spark = docs.sparkSession
    continued = folder is not None
    folder = folder or scratch_path(spark, "dedup-state")
    rows = located(docs)
    earlier = _files(spark, folder)
    arrivals = (_digest(rows).select(F.col("doc_id").cast("long").alias("doc_id"), "__tw_digest", "__tw_file", "__tw_row"))
    path = scratch_path(spark, "dedup-arrivals")
    arrivals.write.parquet(path)
    arrivals = spark.read.schema(arrivals.schema).parquet(path)
    if continued:                                      # the state follows one growing source
        before = spark.read.schema(arrivals.schema).parquet(f"{folder}/arrivals").join(
            arrivals.select("__tw_file").distinct(), "__tw_file", "left_anti") if earlier else None
        path = f"{folder}/arrivals"
        arrivals.write.mode("append").parquet(path)
        _note_files(rows, folder)
    run_state(path, arrivals.schema, folder, spark)
    schema = "__tw_digest binary, keeper struct<doc_id: long, __tw_file: long, __tw_row: long>, group_size long, batch int"
    groups = spark.read.schema(schema).parquet(f"{folder}/groups") if children(spark, f"{folder}/groups") \
        else spark.createDataFrame([], schema)
    groups = (groups.groupBy("__tw_digest").agg(F.max(F.struct("batch", "keeper", "group_size")).alias("last"))
              .select("__tw_digest", "last.keeper", "last.group_size").where("group_size > 1"))
    hits = save(groups, "dedup-hits")

    content = _digest(rows).select("__tw_digest", text_or_empty().alias("text"), "doc_id", "__tw_file", "__tw_row")
    texts = save(maybe_among(content, hits, "__tw_digest").where("__tw_maybe").drop("__tw_maybe").join(hits.hint("merge"), "__tw_digest"),
                 "dedup-hit-texts")
    keepers = texts.where("__tw_file = keeper.__tw_file and __tw_row = keeper.__tw_row").select(
        F.col("__tw_digest").alias("_d"), F.col("text").alias("kept_text"))
    if earlier:
        kept = texts.select(F.col("__tw_digest").alias("_d"), "keeper.*").distinct().join(
            arrivals.select("__tw_file").distinct(), "__tw_file", "left_anti")
        keepers = keepers.unionByName(_texts_of(spark, kept, earlier).select("_d", F.col("text").alias("kept_text")))
    differ = texts.join(keepers.hint("merge"), F.col("__tw_digest") == F.col("_d")).where("text != kept_text").select("__tw_digest")
    decided = arrivals.join(hits.hint("merge"), "__tw_digest", "left").select(
        "doc_id", "__tw_digest", "__tw_file", "__tw_row", F.coalesce("keeper", F.struct("doc_id", "__tw_file", "__tw_row")).alias("keeper"),
        F.coalesce("group_size", F.lit(1)).alias("group_size"))
    if differ.take(1):
        digests = save(differ.distinct(), "dedup-shared-digests")
        others = _texts_of(spark, before.join(digests, "__tw_digest", "left_semi"), earlier) if earlier else None
        decided = _regroup(decided, texts, digests, others)
    return decided.select(
        "doc_id", F.col("keeper.doc_id").alias("keep_id"), "group_size",
        ((F.col("__tw_file") == F.col("keeper.__tw_file")) & (F.col("__tw_row") == F.col("keeper.__tw_row"))).alias("kept"),
        "__tw_digest", "__tw_file", "__tw_row"), rows


def _regroup(decided: DataFrame, texts: DataFrame, digests: DataFrame, others: DataFrame | None) -> DataFrame:
    """Groups by the full text for digests that different texts share; ``others``: rows of earlier arrivals with them."""
    odd = texts.join(digests, "__tw_digest", "left_semi").drop("keeper", "group_size")
    every = odd if others is None else odd.unionByName(others.select(*odd.columns))
    exact = every.groupBy("text").agg(F.max(F.struct("doc_id", "__tw_file", "__tw_row")).alias("keeper"),
                                    F.count(F.lit(1)).alias("group_size"))
    again = odd.join(exact, "text").select("doc_id", "__tw_digest", "__tw_file", "__tw_row", "keeper", "group_size")
    return decided.join(digests, "__tw_digest", "left_anti").unionByName(again)


def _files(spark, folder: str) -> list[str]:
    """Names of the lists of files, one list an arrival."""
    return [f"{folder}/files/{n}" for n in children(spark, f"{folder}/files") if n.startswith("arrival=")]


def _note_files(rows: DataFrame, folder: str) -> None:
    """Add the files of ``rows`` to the folder's lists (paths, one row a file)."""
    n = len(_files(rows.sparkSession, folder))
    rows.select(F.col("_metadata.file_path").alias("path"), "__tw_file").distinct().write.parquet(f"{folder}/files/arrival={n}")


def _texts_of(spark, places: DataFrame, lists: list[str]) -> DataFrame:
    """``places`` (with __tw_file, __tw_row) of earlier arrivals with the ``text`` that stands there."""
    places = save(places, "dedup-earlier-places")
    paths = [r["path"] for r in spark.read.parquet(*lists).join(places.select("__tw_file").distinct(), "__tw_file", "left_semi")
             .select("path").distinct().collect()]     # names of files, not of rows
    if not paths:
        stored = spark.createDataFrame([], "__tw_file long, __tw_row long, text string")
    else:
        stored = located(spark.read.parquet(*paths)).select("__tw_file", "__tw_row", text_or_empty().alias("text"))
    found = save(places.join(stored, ["__tw_file", "__tw_row"]), "dedup-earlier-texts")
    if found.count() != places.count():
        raise RuntimeError("texts of earlier arrivals can no longer be read")
    return found


def exact_duplicates(docs: DataFrame, folder: str | None = None) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for every row; see ``decide``."""
    rows, _ = decide(docs, folder)
    return rows.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("__tw_digest")).alias("text_sha256"))


def drop_exact_duplicates(docs: DataFrame, folder: str | None = None) -> DataFrame:
    """The rows that stay, with the columns of ``docs``; rows without a copy are not shuffled."""
    rows, located_docs = decide(docs, folder)
    return without_rows(located_docs, rows.where("not kept")).select(*[f"`{c}`" for c in docs.columns])
