"""

Every query reads the driver's tables from ``sf_dir`` (or data Spark derives
from them), over whole tables.  Audit timestamps (``current_timestamp()``)
are left out so results are comparable.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

import oracle_queries as OQ
from tidewater.operators import scd2 as H
from tidewater.functions.expressions import parse_multi_ts
from tidewater.operators.clean import normalize_columns
from tidewater.plans import ingest as I
from tidewater.plans.customers import customer_metrics, reference_date
from tidewater.plans.model import Medallion, customer_history, product_history
from tidewater.plans.products import product_metrics, product_rates
from tidewater.functions.expressions import miles_to_km
from tidewater.operators import lookups as L
from tidewater.operators import silver as SV
from tidewater.functions.expressions import int_to_bool
from tidewater.plans.customers import customer_quintiles, customers360, rfm_scores
from tidewater.plans.products import product_quantiles
from tidewater.plans.enrich import orders_enriched, stored_dimensions
from tidewater.plans.pipeline import refresh_all
from tidewater.sinks.tables import materialize, read_published, write_keyed
from tidewater.schemas import CORRUPT_COL
from tidewater.sources import synth
from tidewater.session import delete_path, folder_bytes, scratch_path, shared_dir, table_path
from tidewater.streaming import bronze as SB
from tidewater.streaming import ingest as IN
from tidewater.streaming import silver as SS
from tidewater.streaming.scd2_refresh import read_dimension, start_scd2_stream

try:                            # the subpackage and its pipeline are optional; everything else works without them
    import corpus_pipeline
    from tidewater.llm import queries as LLM
except ImportError:
    LLM = None

SMOKE_DIR = "/root/testdata/sf0.001"


def _m(spark: SparkSession, sf_dir: str) -> Medallion:
    shared_dir(spark)
    return Medallion(spark, sf_dir)


def _lazy(spark: SparkSession, sf_dir: str) -> Medallion:
    """For queries of one layer: nothing is stored, the scans are pruned."""
    shared_dir(spark)
    return Medallion(spark, sf_dir, materialize_bronze=False)


def _events_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = spark.read.parquet(table_path(sf_dir, "events")).select("user_id", "ts", "event_type", "value")
    return H.scd2(ev, ["user_id"], "ts", ["event_type"])


def _landing(spark: SparkSession, sf_dir: str, **kw) -> str:
    shared_dir(spark)
    return I.write_landing(spark, sf_dir, **kw)


def _parse_ts(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = normalize_columns(I.untyped_lines(spark, _landing(spark, sf_dir)))
    return raw.select(
        F.col("order_id").alias("order_id_text"),
        F.col("order_item_id").alias("order_item_id_text"),
        F.col("order_date_dateorders").alias("order_date_text"),
        parse_multi_ts("order_date_dateorders").alias("order_date"),
        F.col("shipping_date_dateorders").alias("shipping_date_text"),
        parse_multi_ts("shipping_date_dateorders").alias("shipping_date"))


def _compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze after an ingestion in several batches, packed into files by bytes."""
    n = spark.read.parquet(table_path(sf_dir, "lineitem")).count()
    landing, root = _landing(spark, sf_dir, lines_per_file=max(1, min(I.LINES_PER_FILE, n // 4))), scratch_path(spark, "lines")
    share = max(1, folder_bytes(spark, landing) // 4)
    IN.start_ingest(spark, landing, root, scratch_path(spark, "cp-lines"), max_bytes_per_trigger=str(share)).awaitTermination()
    IN.compact_lines(spark, root)
    return IN.read_lines(spark, root, "bronze").drop("ingested_at")


def _latin1(spark: SparkSession, sf_dir: str) -> DataFrame:
    enc = "ISO-8859-1"
    path = _landing(spark, sf_dir, encoding=enc, name="landing-latin1",
                    transform=lambda d: d.withColumn("customer_fname", F.concat("customer_fname", F.lit("é"))))
    return I.cleaned_lines(spark, path, encoding=enc)


def _stream_bronze(spark: SparkSession, sf_dir: str) -> str:
    landing = _landing(spark, sf_dir)
    out = scratch_path(spark, "bronze")
    SB.start_bronze(spark, landing, out, scratch_path(spark, "cp-bronze")).awaitTermination()
    delete_path(spark, landing)                                              # this run's own files, all read
    return out


def _stream_silver_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    bronze = _stream_bronze(spark, sf_dir)
    out = scratch_path(spark, "silver-orders")
    SS.start_silver_orders(spark, bronze, out, scratch_path(spark, "cp-silver")).awaitTermination()
    return spark.read.parquet(out)


def _scd2_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events split into 10 files by time range, fed one file per micro-batch."""
    ev = spark.read.parquet(table_path(sf_dir, "events")).select("user_id", "ts", "event_type", "value")
    src = scratch_path(spark, "events-landing")
    ev.repartitionByRange(10, "ts").write.parquet(src)
    changes = spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1).parquet(src)
    dim = scratch_path(spark, "dim-events")
    start_scd2_stream(changes, scratch_path(spark, "events-log"), dim, scratch_path(spark, "cp-dim"),
                      ["user_id"], "ts", ["event_type"], key_buckets=16).awaitTermination()
    return read_dimension(spark, dim)


def _pipeline(spark: SparkSession, sf_dir: str):
    """Full medallion refresh over landing files (dimension changes ordered by ship date)."""
    # every folder is this run's own: what no later step reads would only fill the disk
    return refresh_all(spark, _landing(spark, sf_dir), scratch_path(spark, "pipeline"), sequence_col="shipping_date_dateorders",
                       release=lambda folders: [delete_path(spark, f) for f in folders])


def _pipe_table(name: str, audit: str):
    return lambda s, d: read_published(s, getattr(_pipeline(s, d), name)).drop(audit)


CHANGE_K, CHANGE_SEED = 5, 42
CHANGE_AT = "2099-12-31 00:00:00"


def _changes(spark: SparkSession, sf_dir: str):
    m = _m(spark, sf_dir)
    return m, synth.change_load(m.bronze, CHANGE_K, CHANGE_SEED)


def _with_changes(spark: SparkSession, sf_dir: str):
    """Bronze plus a change load that arrives after every base line."""
    m, ch = _changes(spark, sf_dir)
    late = ch.withColumn("ingested_at", F.lit(CHANGE_AT).cast("timestamp_ntz"))
    return m, m.bronze.unionByName(late)


def _scd2_after_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, b = _with_changes(spark, sf_dir)
    return customer_history(b)


def _customers360_after_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    m, b = _with_changes(spark, sf_dir)
    dims = stored_dimensions(H.current(customer_history(b)), H.current(product_history(b)))
    return customers360(orders_enriched(SV.silver_orders(b), *dims))


def _distinct_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    m, ch = _changes(spark, sf_dir)
    base = L.distinct_count(m.bronze, ["customer_id"], "base_customers")
    changed = L.distinct_count(ch, ["customer_id"], "changed_customers")
    rows = L.rows_of_keys(m.bronze, ch, ["customer_id"]).agg(F.count(F.lit(1)).alias("base_rows_of_changed"))
    return base.crossJoin(changed).crossJoin(rows)      # three one-row aggregates


def _rows_of_changed(spark: SparkSession, sf_dir: str) -> DataFrame:
    m, ch = _changes(spark, sf_dir)
    return L.rows_of_keys(m.bronze, ch, ["customer_id"])


def _sql_current_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    _lazy(spark, sf_dir).dim_products.createOrReplaceTempView("dim_silver_products")
    return spark.sql("SELECT * FROM dim_silver_products WHERE __END_AT IS NULL")


def _key_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All versions of one given product."""
    return H.key_history(_lazy(spark, sf_dir).dim_products, "product_id", 1)


def _stored_key_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All versions of one given product, from a stored dimension in key order."""
    path = write_keyed(_lazy(spark, sf_dir).dim_products, scratch_path(spark, "dim-products-keyed"), "product_id")
    return H.key_history(spark.read.parquet(path), "product_id", 1)


def _audit_stamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audit time of the silver orders of one triggered run: rows, rows that carry it, values of it (one per micro-batch)."""
    out = scratch_path(spark, "silver-orders-audited")
    SS.start_silver_orders(spark, _stream_bronze(spark, sf_dir), out, scratch_path(spark, "cp-audited"), audit=True).awaitTermination()
    return spark.read.parquet(out).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("processed_at").alias("n_stamped"),
        F.count_distinct("processed_at").alias("n_stamps"))


def _busiest_key_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    hist = materialize(spark, _lazy(spark, sf_dir).dim_products, "dim-products")
    return hist.join(F.broadcast(L.most_frequent_key(hist, "product_id")), "product_id", "left_semi")


def _synth_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A synthetic landing line for each row of lineitem: numbered by file and row, with that row's order and product."""
    shared_dir(spark)
    rows = spark.read.parquet(table_path(sf_dir, "lineitem")).select(
        "l_orderkey", "l_partkey", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    earlier = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)             # over one row a file
    files = rows.groupBy("_file").agg(F.count(F.lit(1)).alias("_n")).select(
        "_file", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    product = F.col("l_partkey").cast("long")
    return synth.synthetic_lines(rows.join(F.broadcast(files), "_file").withColumn("id", F.col("_before") + F.col("_row")), seed=42, given={
        "order_id": F.col("l_orderkey").cast("long"), "product_card_id": product, "order_item_cardprod_id": product})


def _int_to_bool(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = normalize_columns(I.untyped_lines(spark, _landing(spark, sf_dir)))
    return raw.select(
        F.col("order_id").alias("order_id_text"),
        F.col("late_delivery_risk").alias("late_delivery_risk_text"),
        F.col("product_status").alias("product_status_text"),
        int_to_bool(F.col("late_delivery_risk").cast("int")).alias("late_delivery_risk"),
        int_to_bool(F.col("product_status").cast("int")).alias("product_status"))


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: customers360 (RFM segmentation) over the sf0.001 tables."""
    return _m(spark, SMOKE_DIR).customers360()


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "orders_enriched": lambda s, d: _m(s, d).stored_orders_enriched,
        "customer_metrics": lambda s, d: customer_metrics(_m(s, d).enriched_lines),
        "customers360": lambda s, d: _m(s, d).customers360(),
        "product_metrics": lambda s, d: product_metrics(_m(s, d).enriched_lines),
        "product_rates": lambda s, d: product_rates(product_metrics(_m(s, d).enriched_lines)),
        "products360": lambda s, d: _m(s, d).products360(),
        "reference_date": lambda s, d: reference_date(_m(s, d).orders_enriched),
        "silver_orders": lambda s, d: _lazy(s, d).silver_orders,
        "silver_customers": lambda s, d: _lazy(s, d).silver_customers,
        "silver_products": lambda s, d: _lazy(s, d).silver_products,
        "scd2_batch": _events_history,
        "scd2_batch_products": lambda s, d: _lazy(s, d).dim_products,
        "scd2_customers": lambda s, d: _lazy(s, d).dim_customers,
        "scd2_current": lambda s, d: H.current(_events_history(s, d)),
        "scd2_closed": lambda s, d: H.closed(_events_history(s, d)),
        "csv_batch_untyped": lambda s, d: I.untyped_lines(s, _landing(s, d)),
        "normalize_columns": lambda s, d: normalize_columns(I.untyped_lines(s, _landing(s, d))),
        "parse_multi_ts": _parse_ts,
        "clean_lines": lambda s, d: I.cleaned_lines(s, _landing(s, d)),
        "csv_batch_latin1": _latin1,
        "expect_or_drop": lambda s, d: I.bronze_batch(s, _landing(s, d)),
        "quarantine_malformed": lambda s, d: I.quarantine_batch(s, _landing(s, d)).drop(CORRUPT_COL),
        "expectation_metrics": lambda s, d: I.rule_metrics_batch(s, _landing(s, d)),
        "bronze_compacted": _compacted,
        "stream_csv_to_bronze": lambda s, d: s.read.parquet(_stream_bronze(s, d)).drop("ingested_at"),
        "stream_silver_orders": _stream_silver_orders,
        "scd2_stream": _scd2_stream,
        "pipeline_orders_enriched": _pipe_table("orders_enriched", "enriched_at"),
        "pipeline_customers360": _pipe_table("customers360", "processed_at"),
        "pipeline_products360": _pipe_table("products360", "processed_at"),
        "customers360_range": lambda s, d: Medallion(s, d, ntile_method="range").customers360(),
        "products360_range": lambda s, d: Medallion(s, d, ntile_method="range").products360(),
        "synth_changes": lambda s, d: _changes(s, d)[1],
        "rows_of_changed_keys": _rows_of_changed,
        "distinct_customer_count": _distinct_counts,
        "scd2_after_changes": _scd2_after_changes,
        "customers360_after_changes": _customers360_after_changes,
        "distinct_customers": lambda s, d: L.distinct_rows(_m(s, d).orders_enriched, [
            "customer_id", "customer_firstname", "customer_lastname", "customer_segment", "customer_zipcode"]),
        "miles_to_km": lambda s, d: s.read.parquet(table_path(d, "events")).select(
            "event_id", "value", miles_to_km("value").alias("value_km")),
        "sql_current_dim": _sql_current_dim,
        "scd2_key_history": _key_history,
        "scd2_stored_key_history": _stored_key_history,
        "audit_stamps": _audit_stamps,
        "scd2_busiest_key_history": _busiest_key_history,
        "synth_lines": _synth_lines,
        "customer_quintiles": lambda s, d: customer_quintiles(_m(s, d).enriched_lines),
        "rfm_scores": lambda s, d: rfm_scores(customer_quintiles(_m(s, d).enriched_lines)),
        "product_quantiles": lambda s, d: product_quantiles(_m(s, d).enriched_lines),
        "int_to_bool": _int_to_bool,
        **(LLM.queries() | {"pipeline": corpus_pipeline.run} if LLM else {}),
    }


def oracle_sql() -> dict[str, str]:
    sql = {**OQ.QUERIES, **(LLM.oracle_sql() if LLM else {})}
    if LLM and corpus_pipeline.ORACLE_SQL:
        sql["pipeline"] = corpus_pipeline.ORACLE_SQL
    return sql
