"""Malformed lines, headers and caps of the landing path."""

import os

import pytest
from pyspark.sql import functions as F

from tidewater.functions.expressions import exact_avg, money_sum
from tidewater.operators.clean import clean
from tidewater.operators.rules import expect_or_drop
from tidewater.plans import ingest as I
from tidewater.schemas import CORRUPT_COL, RAW_HEADERS
from tidewater.sources.landing import read_landing, stream_landing

SF = "/root/testdata/sf0.001"


def _folder(tmp_dir, header, lines):
    path = tmp_dir("csv")
    os.makedirs(path)
    with open(f"{path}/a.csv", "w") as f:
        f.write("\n".join([",".join(header), *lines]) + "\n")
    return path


def _good_line(spark):
    from tidewater.sources.testmap import raw_text_lines
    row = raw_text_lines(spark, SF, defects=False).limit(1).collect()[0]
    return ["" if v is None else str(v) for v in row]


def test_malformed_does_not_depend_on_the_selected_columns(spark, tmp_dir):
    good = _good_line(spark)
    bad = list(good)
    bad[RAW_HEADERS.index("Category Id")] = "no number"
    path = _folder(tmp_dir, RAW_HEADERS, [",".join(good), ",".join(bad), ",".join(good[:20])])
    bronze = I.bronze_batch(spark, path)
    assert bronze.count() == len(bronze.collect()) == len(bronze.select("order_id").collect()) == 1
    assert bronze.agg(F.count(F.lit(1))).first()[0] == 1
    assert I.rule_metrics_batch(spark, path).first()["malformed"] == 2
    assert I.rule_metrics_batch(spark, path).select("malformed").first()[0] == 2
    q = I.quarantine_batch(spark, path)
    assert q.count() == 2 and q.select("failed_rules").where("failed_rules like 'malformed%'").count() == 2
    raw = sorted(r[0] for r in q.select(CORRUPT_COL).collect())
    assert any("no number" in r for r in raw) and ",".join(good[:20]) in raw
    assert expect_or_drop(clean(read_landing(spark, path))).select("market").count() == 1


def test_reordered_header_is_refused(spark, tmp_dir):
    good = _good_line(spark)
    header = list(RAW_HEADERS)
    i, j = header.index("Customer Id"), header.index("Order Id")
    header[i], header[j] = header[j], header[i]
    path = _folder(tmp_dir, header, [",".join(good)])
    with pytest.raises(Exception, match="header"):
        I.bronze_batch(spark, path).collect()
    out, cp = tmp_dir("out"), tmp_dir("cp")
    q = (stream_landing(spark, path).writeStream.format("parquet").option("checkpointLocation", cp)
         .trigger(availableNow=True).start(out))
    with pytest.raises(Exception):
        q.awaitTermination()


def test_large_item_ids_and_sums(spark, tmp_dir):
    good = _good_line(spark)
    good[RAW_HEADERS.index("Order Item Id")] = str(10**12)
    path = _folder(tmp_dir, RAW_HEADERS, [",".join(good)])
    assert I.bronze_batch(spark, path).first()["order_item_id"] == 10**12
    df = spark.sql("select cast(6e13 as decimal(18,4)) as v from range(4)")
    assert df.agg(money_sum("v")).first()[0] == 2.4e14 and df.agg(exact_avg("v")).first()[0] == 6e13
    assert spark.range(3).select((F.col("id") + F.lit(10**17)).alias("v")).agg(exact_avg("v")).first()[0] == pytest.approx(1e17)


def test_changes_in_one_file_follow_order_date(spark):
    from tidewater.plans.model import customer_history
    from tidewater.sources.testmap import bronze_from_tables
    one = bronze_from_tables(spark, SF).limit(1)
    at = lambda seg, day, item: one.withColumns({
        "customer_segment": F.lit(seg), "order_item_id": F.lit(item).cast("long"), "customer_id": F.lit(1).cast("long"),
        "order_date_dateorders": F.lit(f"2024-01-0{day} 00:00:00").cast("timestamp_ntz"),
        "ingested_at": F.lit("2024-02-01 00:00:00").cast("timestamp_ntz")})
    rows = at("Home Office", 1, 1).unionByName(at("Consumer", 2, 1)).unionByName(at("Corporate", 2, 2))
    assert [r.customer_segment for r in customer_history(rows).collect()] == ["Corporate"]


def test_cluster_sessions_need_a_shared_folder(spark, monkeypatch):
    from tidewater import session

    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "spark://host:7077"

    class Cluster:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError):
        session.shared_dir(Cluster())


def test_landing_files_are_compressed_and_bounded_in_lines(spark):
    import os
    from tidewater.plans import ingest as I
    sf = "/root/testdata/sf0.001"
    path = I.write_landing(spark, sf, lines_per_file=1000)
    n = spark.read.parquet(f"{sf}/lineitem.parquet").count()
    names = [f for f in os.listdir(path) if f.startswith("part-")]
    assert all(f.endswith(".csv.gz") for f in names) and len(names) >= n / 1000
    sizes = I.untyped_lines(spark, path).groupBy("_metadata.file_path").count().collect()
    assert max(r["count"] for r in sizes) <= 1000 and sum(r["count"] for r in sizes) == n
    assert sum(os.path.getsize(f"{path}/{f}") for f in names) < 150 * n           # plain text takes some 350 bytes a line
