import datetime as dt
import itertools
from decimal import Decimal

from pyspark.sql import functions as F

from tidewater.functions import labels as LB
from tidewater.plans.customers import customers360
from tidewater.plans.enrich import orders_enriched
from tidewater.plans.products import product_metrics, products360

ENRICHED = ("order_id long, customer_id long, product_id long, customer_firstname string, "
            "customer_lastname string, customer_segment string, customer_zipcode int, "
            "line_total decimal(18,4), profit_per_order decimal(18,4), order_date timestamp_ntz")


def _line(oid, cid, day, amount, seg="Consumer"):
    name = None if cid is None else f"n{cid}"
    return (oid, cid, 1, name, name, None if cid is None else seg, None if cid is None else 1,
            Decimal(amount), Decimal("1.0000"), dt.datetime(2018, 1, day))


def test_null_customer_is_prospect(spark):
    rows = [_line(i, i % 7, 1 + i % 28, "10.5000") for i in range(40)]
    rows += [_line(100, None, 3, "5.0000"), _line(101, None, 4, "6.0000")]
    out = {r.customer_id: r for r in customers360(spark.createDataFrame(rows, ENRICHED)).collect()}
    p = out[None]
    assert (p.total_orders, p.total_revenue, p.days_since_last_order) == (0, 0.0, 999999)
    assert (p.recency_score, p.frequency_score, p.monetary_score, p.rfm_segment) == (1, 1, 1, "Prospects")
    assert p.latest_order_date is None and p.avg_order_value == 0.0
    assert all(r.total_orders > 0 for k, r in out.items() if k is not None)


def test_rfm_rule_order(spark):
    combos = [(r, f, m, o) for r, f, m in itertools.product(range(1, 6), repeat=3) for o in (0, 3)]
    df = spark.createDataFrame(combos, "r int, f int, m int, o long")
    got = df.select("r", "f", "m", "o", LB.rfm_segment(F.col("r"), F.col("f"), F.col("m"), F.col("o")).alias("s"))
    labels = {(x.r, x.f, x.m, x.o): x.s for x in got.collect()}
    assert labels[(5, 5, 5, 3)] == "Champions"
    assert labels[(3, 3, 3, 3)] == "Loyal Customers"
    assert labels[(4, 2, 1, 3)] == "Potential Loyalists"
    assert labels[(5, 1, 1, 3)] == "New Customers"
    assert labels[(2, 3, 3, 3)] == "At Risk"
    assert labels[(2, 2, 1, 3)] == "Hibernating"
    assert labels[(1, 1, 1, 3)] == "Lost Customers"
    assert labels[(3, 1, 1, 0)] == "Prospects"
    assert labels[(3, 1, 1, 3)] == "Other"
    assert "Cannot Lose Them" not in set(labels.values())    # shadowed by At Risk


def test_unreachable_tiers_and_margins(spark):
    df = spark.range(1, 6).select(F.col("id").cast("int").alias("s"))
    tiers = {r[0] for r in df.select(LB.performance_tier(F.col("s"))).collect()}
    margins = {r[0] for r in df.select(LB.margin_category(F.col("s"))).collect()}
    assert "Slow Movers" not in tiers and "Very Low Margin" not in margins


def test_health_and_priority_boundaries(spark):
    rows = [("Star Products", "High Margin", 0.9, 0.049, 0.0),
            ("Star Products", "Low Margin", 0.9, 0.05, 0.0),
            ("Strong Performers", "Low Margin", 0.85, 0.10, 0.05),
            ("Weak Performers", "Low Margin", 0.8, 0.1000001, 0.0),
            ("Weak Performers", "Low Margin", 0.79, 0.0, 0.0),
            ("Weak Performers", "Low Margin", 0.9, 0.15, 0.10),
            ("Weak Performers", "Low Margin", 0.9, 0.1500001, 0.0),
            ("Weak Performers", "Low Margin", 0.9, 0.0, 0.1000001)]
    df = spark.createDataFrame(rows, "tier string, margin string, comp double, canc double, fraud double")
    t, m, c, k, fr = (F.col(x) for x in ("tier", "margin", "comp", "canc", "fraud"))
    out = df.select(LB.product_health(t, c, k, fr).alias("h"), LB.strategic_priority(t, m, k, fr).alias("p")).collect()
    assert [r.h for r in out] == ["Healthy", "Monitor", "Monitor", "At Risk", "At Risk", "At Risk", "At Risk", "At Risk"]
    assert [r.p for r in out] == ["Invest & Promote", "Maintain", "Maintain", "Maintain", "Maintain", "Maintain",
                                  "Investigate Quality Issues", "Investigate Quality Issues"]


def test_status_buckets(spark):
    statuses = ["COMPLETE", "CLOSED", "CANCELED", "PENDING_PAYMENT", "SUSPECTED_FRAUD", "ON_HOLD"]
    rows = [(i, 7, 1, "P", "Cat", Decimal("9.9900"), False, s, "Corporate", Decimal("1.0000"),
             Decimal("0.1000"), Decimal("0.0500"), 2, dt.datetime(2018, 1, 1), dt.datetime(2018, 1, 3), True)
            for i, s in enumerate(statuses)]
    schema = ("order_id long, product_id long, quantity int, product_name string, category_name string, "
              "product_price decimal(18,4), is_notavailable boolean, order_status string, customer_segment string, "
              "line_total decimal(18,4), profit_per_order decimal(18,4), discount_rate decimal(18,4), "
              "actual_shipping_days int, order_date timestamp_ntz, shipping_date timestamp_ntz, "
              "late_delivery_risk boolean")
    df = spark.createDataFrame(rows, schema).withColumn("customer_id", F.col("order_id")) \
        .withColumn("profit_ratio", F.col("discount_rate"))
    r = product_metrics(df).collect()[0]
    assert (r.completed_orders, r.canceled_orders, r.fraud_orders, r.pending_orders) == (1, 2, 1, 1)
    assert r.total_orders == 6 and r.late_deliveries == 6 and r.avg_order_cycle_days == 2.0
    assert r.corporate_orders == 6 and r.unique_customers == 6
    p = products360(df).collect()[0]
    assert p.revenue_score == 5 and p.performance_tier == "Star Products"


def test_join_miss_keeps_line(spark):
    orders = spark.createDataFrame([(1, 10, 100), (2, 99, 999)], "order_id long, customer_id long, product_id long")
    cust = spark.createDataFrame([(10, "a", "b", "Consumer", 5)],
                                 "customer_id long, customer_firstname string, customer_lastname string, "
                                 "customer_segment string, customer_zipcode int")
    prod = spark.createDataFrame([(100, "p", 3, "c", False)],
                                 "product_id long, product_name string, category_id int, category_name string, "
                                 "is_notavailable boolean")
    out = {r.order_id: r for r in orders_enriched(orders, cust, prod).collect()}
    assert out[1].customer_segment == "Consumer" and out[1].product_name == "p"
    assert out[2].customer_segment is None and out[2].product_name is None


def test_product_metrics_read_the_lines_once_and_count_customers_exactly(spark, tmp_dir):
    schema = ("order_id long, customer_id long, product_id long, product_name string, category_name string, product_price decimal(18,4), "
              "is_notavailable boolean, customer_segment string, order_status string, quantity int, line_total decimal(18,4), "
              "profit_per_order decimal(18,4), discount_rate decimal(18,4), profit_ratio decimal(18,4), order_date timestamp_ntz, "
              "shipping_date timestamp_ntz, actual_shipping_days int, late_delivery_risk boolean")
    day, one = dt.datetime(2020, 1, 1), Decimal("1.0000")
    ids = [1, 1, 40_000, 10**12, -5, None, 40_001, 1]             # several ranges of ids, one below zero, one missing
    rows = [(i, c, i % 2, "p", "c", one, None, "Consumer", "COMPLETE", 2, one * i, one, None, one, day, day + dt.timedelta(days=i), 3, i % 3 == 0)
            for i, c in enumerate(ids * 5)]
    path = tmp_dir("lines")
    spark.createDataFrame(rows, schema).write.parquet(path)
    df = product_metrics(spark.read.parquet(path))
    assert df._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    got = {r.product_id: r for r in df.collect()}
    for p in (0, 1):
        own = [r for r in rows if r[2] == p]
        assert got[p].unique_customers == len({r[1] for r in own} - {None}) and got[p].total_orders == len(own) == 20
        assert got[p].total_revenue == float(sum(r[10] for r in own)) and got[p].units_sold == 40
        assert got[p].avg_order_cycle_days == sum(r[0] for r in own) / 20 and got[p].avg_discount_rate is None
        assert got[p].late_deliveries == sum(r[17] for r in own)


def test_metrics_are_stored_once_for_all_ntiles(spark, monkeypatch):
    from tidewater.operators import ranking
    from tidewater.plans import customers
    names = []
    for module in (ranking, customers):
        kept = module.materialize
        monkeypatch.setattr(module, "materialize", lambda s, df, name, *a, kept=kept: names.append(name) or kept(s, df, name, *a))
    rows = [_line(i, i % 7, 1 + i % 28, "10.5000") for i in range(40)]
    assert customers360(spark.createDataFrame(rows, ENRICHED)).count() == 7
    assert names == ["customer-metrics"]
