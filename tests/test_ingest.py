import os
import shutil

import pytest
from pyspark.sql import functions as F

from tidewater.operators.rules import RULES
from tidewater.plans import ingest as I
from tidewater.streaming import bronze as SB
from tidewater.streaming import ingest as N

SF = "/root/testdata/sf0.001"


def _rows(df):
    return sorted(tuple(str(v) for v in r) for r in df.collect())


@pytest.fixture(scope="module")
def landing(spark):
    return I.write_landing(spark, SF, files=6)


def _same_as_batch(spark, landing, root):
    good, bad = N.read_lines(spark, root, "bronze").drop("ingested_at"), N.read_lines(spark, root, "quarantine").drop("ingested_at")
    want, rejected = I.bronze_batch(spark, landing), I.quarantine_batch(spark, landing)
    assert _rows(good) == _rows(want.select(*good.columns))
    assert _rows(bad) == _rows(rejected.select(*bad.columns))
    kept = N.read_rule_metrics(spark, root)
    total = kept.agg(*[F.sum(c).alias(c) for c in ("input_rows", "malformed", *RULES)]).collect()[0].asDict()
    assert total == {k: v for k, v in I.rule_metrics_batch(spark, landing).collect()[0].asDict().items() if k in total}
    return kept


def test_one_stream_gives_bronze_quarantine_and_a_metrics_row_a_batch(spark, tmp_dir, landing):
    root, cp = tmp_dir("lines"), tmp_dir("cp")
    half = tmp_dir("half")
    os.makedirs(half)
    files = sorted(f for f in os.listdir(landing) if f.endswith(".csv"))
    for f in files[:2]:
        shutil.copy(os.path.join(landing, f), half)
    N.start_ingest(spark, half, root, cp, max_files_per_trigger=1).awaitTermination()
    for f in files[2:]:
        shutil.copy(os.path.join(landing, f), half)
    N.start_ingest(spark, half, root, cp, max_files_per_trigger=1).awaitTermination()      # restart
    N.start_ingest(spark, half, root, cp, max_files_per_trigger=1).awaitTermination()      # nothing new
    kept = _same_as_batch(spark, landing, root)
    assert kept.count() == len(files) == kept.select("batch").distinct().count()


@pytest.mark.parametrize("after", ["before any write", "lines", "metrics"])
def test_a_failed_batch_is_repeated_without_loss_or_copy(spark, tmp_dir, landing, monkeypatch, after):
    root, cp = tmp_dir("lines"), tmp_dir("cp")
    real = N.LineSplitter.__call__

    def dies(self, batch, batch_id):
        if batch_id == 1:
            if after != "before any write":
                counts = self.write_lines(batch, batch_id)
            if after == "metrics":
                self.write_metrics(batch.sparkSession, counts, batch_id)
            raise RuntimeError("lost driver")
        real(self, batch, batch_id)

    monkeypatch.setattr(N.LineSplitter, "__call__", dies)
    with pytest.raises(Exception):
        N.start_ingest(spark, landing, root, cp, max_files_per_trigger=2).awaitTermination()
    monkeypatch.setattr(N.LineSplitter, "__call__", real)
    N.start_ingest(spark, landing, root, cp, max_files_per_trigger=2).awaitTermination()
    assert _same_as_batch(spark, landing, root).count() == 3


def test_batches_are_bounded_by_bytes_and_files_archived(spark, tmp_dir, landing):
    own, root, cp, archive = tmp_dir("own"), tmp_dir("lines"), tmp_dir("cp"), tmp_dir("archive")
    shutil.copytree(landing, own)
    csv = [f for f in os.listdir(own) if f.endswith(".csv")]
    largest = max(os.path.getsize(f"{own}/{f}") for f in csv)
    run = lambda: N.start_ingest(spark, own, root, cp, max_bytes_per_trigger=str(3 * largest), archive_dir=archive).awaitTermination()
    run()
    run()
    kept = _same_as_batch(spark, landing, root)
    total = sum(os.path.getsize(f"{landing}/{f}") for f in csv)
    assert kept.count() >= total / (3 * largest)
    moved = {f for _, _, names in os.walk(archive) for f in names if f.endswith(".csv")}
    left = {f for f in os.listdir(own) if f.endswith(".csv")}
    assert moved and not moved & left and moved | left == set(csv)


def test_landing_text_is_scanned_once(spark, tmp_dir, landing):
    q = N.start_ingest(spark, landing, tmp_dir("lines"), tmp_dir("cp"))
    q.awaitTermination()
    lines = I.rule_metrics_batch(spark, landing).collect()[0]["input_rows"]
    assert sum(p["numInputRows"] for p in q.recentProgress) == lines


def test_listener_keeps_one_row_a_batch_of_a_file_sink_stream(spark, tmp_dir, landing):
    listener = N.RuleMetricsListener(spark, tmp_dir("events"))
    spark.streams.addListener(listener)
    try:
        out, cp = tmp_dir("bronze"), tmp_dir("cp")
        SB.start_bronze(spark, landing, out, cp, max_files_per_trigger=2).awaitTermination()
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(60_000)
    finally:
        spark.streams.removeListener(listener)
    got = listener.table()
    want = I.rule_metrics_batch(spark, landing).collect()[0].asDict()
    total = got.agg(*[F.sum(c).alias(c) for c in want]).collect()[0].asDict()
    assert got.count() == 3 and total == want
