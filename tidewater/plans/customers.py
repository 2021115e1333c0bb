"""customers360: per-customer metrics, RFM scores and segments."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.expressions import money_sum
from ..functions.labels import rfm_segment, score_from_rank
from ..operators.ranking import asc, desc, ntile_columns
from ..sinks.tables import materialize

CUSTOMER_KEYS = ["customer_id", "customer_firstname", "customer_lastname",
                 "customer_segment", "customer_zipcode"]
NO_ORDER_DAYS = 999999

# The columns of the published table, in order.
CUSTOMERS360_COLUMNS = [
    "customer_id", "customer_firstname", "customer_lastname", "customer_segment",
    "customer_zipcode", "total_orders", "total_revenue", "total_profit", "avg_order_value",
    "latest_order_date", "first_order_date", "days_since_last_order", "recency_score",
    "frequency_score", "monetary_score", "rfm_score", "rfm_segment",
]


def reference_date(enriched: DataFrame) -> DataFrame:
    """One row: one month after the latest order date (a date)."""
    return enriched.agg(F.add_months(F.max("order_date"), 1).alias("reference_date"))


def customer_metrics(enriched: DataFrame) -> DataFrame:
    """One aggregation over the lines (partial + final HashAggregate).

    Equivalent to "distinct customers ⟕ their aggregates USING customer_id":
    every customer tuple has aggregates, except that a null ``customer_id``
    never matches in that join, so its metrics read as no orders.
    """
    agg = enriched.groupBy(*CUSTOMER_KEYS).agg(
        F.count("order_id").alias("total_orders"),
        money_sum("line_total").alias("total_revenue"),
        money_sum("profit_per_order").alias("total_profit"),
        F.max("order_date").alias("latest_order_date"),
        F.min("order_date").alias("first_order_date"),
    )
    # The aggregate feeds both the reference date and the metrics: it is stored
    # once in the shared folder so the enrichment joins upstream run once.
    # Latest order over all lines = max over the groups, read from this small
    # table, never collected to the driver.
    agg = materialize(agg.sparkSession, agg, "customer-metrics")
    ref = agg.agg(F.add_months(F.max("latest_order_date"), 1).alias("_ref"))
    miss = F.col("customer_id").isNull()
    m = agg.crossJoin(F.broadcast(ref)).select(      # ref: a global aggregate, exactly one row
        *CUSTOMER_KEYS,
        F.when(miss, F.lit(0)).otherwise(F.col("total_orders")).cast("long").alias("total_orders"),
        F.when(miss, F.lit(0.0)).otherwise(F.col("total_revenue")).alias("total_revenue"),
        F.when(miss, F.lit(0.0)).otherwise(F.col("total_profit")).alias("total_profit"),
        F.when(~miss, F.col("latest_order_date")).alias("latest_order_date"),
        F.when(~miss, F.col("first_order_date")).alias("first_order_date"),
        "_ref",
    )
    days = F.when(F.col("latest_order_date").isNotNull(),
                  F.datediff(F.col("_ref"), F.col("latest_order_date"))).otherwise(F.lit(NO_ORDER_DAYS))
    aov = F.when(F.col("total_orders") > 0, F.col("total_revenue") / F.col("total_orders")).otherwise(F.lit(0.0))
    return (m.withColumn("days_since_last_order", days.cast("int"))
             .withColumn("avg_order_value", aov)
             .drop("_ref"))


def _tiebreak():
    return [asc(c) for c in CUSTOMER_KEYS]


def customer_quintiles(enriched: DataFrame, ntile_method: str = "cuts",
                       ranges: int | None = None) -> DataFrame:
    """Metrics + recency / frequency / monetary quintiles (ntile(5) over all customers)."""
    return ntile_columns(customer_metrics(enriched), [
        ("recency_quintile", 5, [asc("days_since_last_order")] + _tiebreak()),
        ("frequency_quintile", 5, [desc("total_orders")] + _tiebreak()),
        ("monetary_quintile", 5, [desc("total_revenue")] + _tiebreak()),
    ], method=ntile_method, ranges=ranges, stored=True)          # customer_metrics reads a stored table; its keys are unique


def rfm_scores(quintiles: DataFrame) -> DataFrame:
    """Scores ``6 - quintile`` (1 without orders / revenue) and the 3-digit RFM string."""
    orders = F.col("total_orders")
    r = score_from_rank(F.col("recency_quintile"), 6, orders)
    f = score_from_rank(F.col("frequency_quintile"), 6, orders)
    mon = F.when(F.col("total_revenue") == 0, F.lit(1)).otherwise(F.lit(6) - F.col("monetary_quintile")).cast("int")
    return (quintiles.withColumn("recency_score", r)
                     .withColumn("frequency_score", f)
                     .withColumn("monetary_score", mon)
                     .withColumn("rfm_score", F.concat(F.col("recency_score").cast("string"),
                                                       F.col("frequency_score").cast("string"),
                                                       F.col("monetary_score").cast("string"))))


def customers360(enriched: DataFrame, audit: bool = False, ntile_method: str = "cuts",
                 ranges: int | None = None) -> DataFrame:
    scored = rfm_scores(customer_quintiles(enriched, ntile_method, ranges))
    orders = F.col("total_orders")
    out = scored.withColumn("rfm_segment", rfm_segment(F.col("recency_score"), F.col("frequency_score"),
                                                        F.col("monetary_score"), orders))
    cols = list(CUSTOMERS360_COLUMNS)
    if audit:
        out = out.withColumn("processed_at", F.current_timestamp())
        cols.append("processed_at")
    return out.select(*cols)
