"""What a query leaves on disk while it runs: shuffle files of finished writes, folders that are read no more."""

import glob
import time

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from tidewater.operators.lookups import rows_of_keys
from tidewater.plans import model, pipeline
from tidewater.plans.model import Medallion
from tidewater.session import children, scratch_path, shared_dir
from tidewater.sinks.tables import file_slices, materialize, publish_table, read_published

SF001 = "/root/testdata/sf0.001"


def _shuffle_files(spark) -> set[str]:
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks()
    return {b for i in range(blocks.size()) if (b := blocks.apply(i).name()).startswith("shuffle_")}


def _local(path: str) -> str:
    return path.removeprefix("file://").removeprefix("file:")


def _codecs(path: str) -> set[str]:
    import pyarrow.parquet as pq
    files = glob.glob(f"{_local(path)}/**/part-*.parquet", recursive=True)
    return {pq.ParquetFile(f).metadata.row_group(0).column(0).compression for f in files}


@pytest.fixture()
def no_broadcast(spark):
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "20k")
    yield
    spark.conf.set(name, before)


def test_a_finished_write_leaves_no_shuffle_files(spark):
    before = _shuffle_files(spark)
    df = spark.range(20_000).repartition(5, "id").groupBy((F.col("id") % 1000).alias("k")).count()
    stored = materialize(spark, df, "no-shuffles")
    until = time.time() + 10                            # the executors are told, not waited for
    while _shuffle_files(spark) - before and time.time() < until:
        time.sleep(0.1)
    assert not _shuffle_files(spark) - before
    assert stored.count() == 1000
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"      # only inside writes


def test_few_wanted_keys_move_no_rows(spark, no_broadcast):
    rows = spark.range(50_000).select((F.col("id") % 500).alias("k"), "id", F.col("id").cast("string").alias("text"))
    keys = rows.where("k % 250 = 7").select("k")
    got = rows_of_keys(rows, keys, ["k"])
    assert "SortMergeJoin" not in got._jdf.queryExecution().sparkPlan().toString()
    assert got.count() == 200 and {r.k for r in got.select("k").distinct().collect()} == {7, 257}
    assert rows_of_keys(rows, keys.unionByName(spark.sql("select cast(null as bigint) k")), ["k"]).count() == 200


def _rows(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


def test_enriched_lines_are_joined_in_slices(spark, no_broadcast, monkeypatch):
    spark.conf.set("spark.sql.files.maxRecordsPerFile", "1000")
    try:
        m = Medallion(spark, SF001)
        assert len(m.bronze.inputFiles()) > 4
    finally:
        spark.conf.unset("spark.sql.files.maxRecordsPerFile")
    whole = _rows(m.orders_enriched)
    monkeypatch.setattr(model, "LINES_AT_ONCE", 2000)
    sliced = m.stored_orders_enriched
    assert "orders-enriched-" in sliced.inputFiles()[0] and _rows(sliced) == whole
    assert _rows(m.enriched_lines) == whole
    assert "Window" not in m.enriched_lines._jdf.queryExecution().sparkPlan().toString()
    parts = file_slices(m.bronze, 2000)
    assert len(parts) > 1 and sum(p.count() for p in parts) == m.bronze.count()
    assert file_slices(m.bronze, 10 ** 9) == [m.bronze]


def test_a_version_of_slices_is_seen_whole(spark, tmp_dir):
    path = tmp_dir("sliced")
    publish_table([spark.range(3), spark.range(3, 5), spark.range(5, 9)], path)
    assert sorted(r.id for r in read_published(spark, path).collect()) == list(range(9))

    def broken(i: int):
        if i == 2:
            raise ValueError("a slice fails")
        return i
    fails = F.udf(broken, "long")
    with pytest.raises(Exception, match="a slice fails"):
        publish_table([spark.range(2), spark.range(4).select(fails("id").alias("id"))], path)
    assert read_published(spark, path).count() == 9


def _new_folders(spark, before, name):
    return [f for f in children(spark, f"{shared_dir(spark)}/tidewater") if f.startswith(name) and f not in before]


def test_a_stream_of_landing_files_leaves_only_what_is_read(spark):
    scratch_path(spark, "x")
    before = children(spark, f"{shared_dir(spark)}/tidewater")
    out = E.queries()["stream_silver_orders"](spark, SF001)
    assert out.count() == E.queries()["expect_or_drop"](spark, SF001).count()
    made = _new_folders(spark, before, "landing-")
    assert len(made) == 1                               # that of expect_or_drop, which is lazy
    silver, = _new_folders(spark, before, "silver-orders-")
    bronze, = _new_folders(spark, before, "bronze-")
    assert _codecs(f"{shared_dir(spark)}/tidewater/{silver}") == _codecs(f"{shared_dir(spark)}/tidewater/{bronze}") == {"ZSTD"}


def test_a_pipeline_run_frees_what_no_later_step_reads(spark, monkeypatch):
    monkeypatch.setattr(pipeline, "LINES_AT_ONCE", 2000)
    before = children(spark, f"{shared_dir(spark)}/tidewater")
    got = E.queries()["pipeline_orders_enriched"](spark, SF001)
    root, = _new_folders(spark, before, "pipeline-")
    assert not _new_folders(spark, before, "landing-")
    assert set(children(spark, f"{shared_dir(spark)}/tidewater/{root}")) == {"_checkpoints", "orders_enriched", "customers360", "products360"}
    assert got.count() == E.queries()["expect_or_drop"](spark, SF001).count()
