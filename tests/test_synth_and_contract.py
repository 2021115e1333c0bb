from pyspark.sql import functions as F

from tidewater.operators.clean import clean
from tidewater.sources import synth


def test_generator_invariants(spark):
    df = clean(synth.generate(spark, 3000, seed=7, partitions=3))
    bad = df.filter(
        (F.col("order_item_discount") > F.col("order_item_product_price") * 0.3)
        | (F.col("order_item_total") != ((F.col("order_item_product_price") - F.col("order_item_discount"))
                                         * F.col("order_item_quantity")).cast("decimal(18,2)"))
        | (F.col("days_for_shipping_real") < 1)
        | (F.col("late_delivery_risk") != (F.col("days_for_shipping_real") > F.col("days_for_shipment_scheduled")))
        | ((F.col("shipping_mode") == "Same Day") & (F.col("days_for_shipment_scheduled") != 1))
        | (F.col("late_delivery_risk") & (F.col("delivery_status") != "Late delivery"))
        | ((F.col("delivery_status") == "Shipping canceled") & (F.col("order_status") != "CANCELED"))
        | (F.year("order_date_dateorders") != 2018)
        | F.col("order_date_dateorders").isNull() | F.col("shipping_date_dateorders").isNull()
        | (F.datediff("shipping_date_dateorders", "order_date_dateorders") != F.col("days_for_shipping_real")))
    assert bad.count() == 0
    assert df.select("order_id").distinct().count() == 3000


def test_generator_same_rows_for_any_partitioning(spark):
    a = synth.generate(spark, 500, seed=3, partitions=1).collect()
    b = synth.generate(spark, 500, seed=3, partitions=7).collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))


def test_generator_ids_beyond_32_bits(spark):
    ids = spark.range(3_000_000_000, 3_000_000_010)
    assert [r[0] for r in synth.synthetic_lines(ids).select("order_item_id").orderBy("order_item_id").collect()] == [
        3_000_020_000 + i for i in range(10)]


def test_generated_lines_follow_the_given_rows(spark):
    import __spark_entry__ as E
    lines = E.queries()["synth_lines"](spark, E.SMOKE_DIR)
    source = spark.read.parquet(f"{E.SMOKE_DIR}/lineitem.parquet")
    n = source.count()
    ids = sorted(r[0] for r in lines.select("order_item_id").collect())
    assert ids == list(range(20000, 20000 + n))
    keys = lambda df, *c: sorted(map(tuple, df.select(*c).collect()))
    assert keys(lines, "order_id", "product_card_id") == keys(source, "l_orderkey", "l_partkey")


def test_change_load_changes_every_row_of_chosen_customers(spark):
    base = clean(synth.generate(spark, 2000, seed=1))
    ch = synth.change_load(base, 5, seed=1)
    ids = {r[0] for r in ch.select("customer_id").distinct().collect()}
    assert len(ids) == 5
    assert ch.count() == base.filter(F.col("customer_id").isin(list(ids))).count()
    joined = ch.alias("c").join(base.alias("b"), "order_id")
    assert joined.filter((F.col("c.customer_segment") == F.col("b.customer_segment"))
                         | (F.col("c.product_status") == F.col("b.product_status"))).count() == 0


def test_entry_and_registry(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0
    assert "rfm_segment" in df.columns
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    import oracle_queries
    import re
    own = {k for k in q if k != "pipeline" and not re.match(r"op\d+_", k)}       # the training-data operators are optional
    assert own - set(o) == {"synth_lines"} and set(oracle_queries.QUERIES) == own - {"synth_lines"}


def test_synthetic_lines_are_numbered_without_a_shuffle_of_the_lines(spark, tmp_dir):
    from __spark_entry__ import queries
    sf = tmp_dir("sf")
    spark.range(9).selectExpr("id as l_orderkey", "id as l_partkey").coalesce(1).write.parquet(f"{sf}/lineitem.parquet")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lines = queries()["synth_lines"](spark, sf)
        assert "SortMergeJoin" not in lines._jdf.queryExecution().executedPlan().toString()     # one file: it would be one task
        assert sorted(r.order_id for r in lines.select("order_id").collect()) == list(range(9))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_any_session_gets_methods_that_are_compiled(spark):
    from tidewater.session import shared_dir
    limit = "spark.sql.codegen.hugeMethodLimit"
    other = spark.newSession()
    other.conf.set(limit, "65535")
    shared_dir(other)
    assert other.conf.get(limit) == "8000"
    other.conf.set(limit, "4000")
    shared_dir(other)
    assert other.conf.get(limit) == "4000"
