"""products360: per-product metrics, rates, quantile scores and labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.expressions import guarded_ratio
from ..functions.labels import (SEGMENT_CONSUMER, SEGMENT_CORPORATE, SEGMENT_HOME_OFFICE,
                                STATUS_CANCELED, STATUS_COMPLETE, STATUS_FRAUD, STATUS_PENDING,
                                margin_category, performance_tier, product_health,
                                score_from_rank, strategic_priority)
from ..operators.ranking import asc, desc, ntile_columns

PRODUCT_KEYS = ["product_id", "product_name", "category_name", "product_price", "is_notavailable"]


def _counts() -> dict:
    seg, st = F.col("customer_segment"), F.col("order_status")
    return {
        "total_orders": F.count("order_id"),
        "consumer_orders": F.count_if(seg == SEGMENT_CONSUMER),
        "corporate_orders": F.count_if(seg == SEGMENT_CORPORATE),
        "home_office_orders": F.count_if(seg == SEGMENT_HOME_OFFICE),
        "completed_orders": F.count_if(st == STATUS_COMPLETE),
        "canceled_orders": F.count_if(st.isin(*STATUS_CANCELED)),
        "fraud_orders": F.count_if(st == STATUS_FRAUD),
        "pending_orders": F.count_if(st.isin(*STATUS_PENDING)),
        "late_deliveries": F.count_if(F.col("late_delivery_risk")),
    }


#: Output -> column that is averaged, or summed.
_AVERAGES = {
    "avg_order_value": "line_total", "avg_profit_per_order": "profit_per_order", "avg_discount_rate": "discount_rate",
    "avg_profit_ratio": "profit_ratio", "avg_price_charged": "product_price",
    "avg_order_cycle_days": "cycle_days", "avg_shipping_days": "actual_shipping_days",
}
_SUMS = {"total_revenue": "line_total", "total_profit": "profit_per_order", "units_sold": "quantity"}

# The published columns behind the product keys, in order.
PRODUCT_METRICS = [
    "total_orders", "units_sold", "total_revenue", "total_profit", "avg_order_value", "avg_profit_per_order",
    "avg_discount_rate", "avg_profit_ratio", "avg_price_charged", "unique_customers", "first_order_date", "last_order_date",
    "consumer_orders", "corporate_orders", "home_office_orders", "completed_orders", "canceled_orders", "fraud_orders",
    "pending_orders", "avg_order_cycle_days", "avg_shipping_days", "late_deliveries",
]


def product_metrics(enriched: DataFrame) -> DataFrame:
    """22 aggregates by product in one pass over the lines.

    The exact number of customers comes from bitmaps: a line's customer id is a bit of the bitmap (4 kB, 32,768 ids) of
    its range of ids, and the same aggregation that fills them also sums everything else by (product, range of ids), so
    the lines, and the joins that make them, are read once.  The ranges' partial results, a product's ranges being
    disjoint, are then added by product.  All sums are exact, so the result does not depend on the ranges.
    """
    columns = sorted({*_AVERAGES.values(), *_SUMS.values()})
    lines = enriched.withColumn("cycle_days", F.datediff("shipping_date", "order_date"))
    part = lines.groupBy(*PRODUCT_KEYS, F.bitmap_bucket_number("customer_id").alias("_range")).agg(
        *[c.alias(n) for n, c in _counts().items()],
        *[F.sum(c).alias(f"_sum_{c}") for c in columns], *[F.count(c).alias(f"_n_{c}") for c in columns],
        F.min("order_date").alias("first_order_date"), F.max("order_date").alias("last_order_date"),
        F.bitmap_construct_agg(F.bitmap_bit_position("customer_id")).alias("_bits"))
    out = part.groupBy(*PRODUCT_KEYS).agg(
        *[F.sum(n).alias(n) for n in _counts()],
        *[(F.sum(f"_sum_{c}").cast("double") / F.sum(f"_n_{c}").cast("double")).alias(n) for n, c in _AVERAGES.items()],
        *[F.sum(f"_sum_{c}").cast("long" if n == "units_sold" else "double").alias(n) for n, c in _SUMS.items()],
        F.min("first_order_date").alias("first_order_date"), F.max("last_order_date").alias("last_order_date"),
        F.sum(F.bitmap_count("_bits")).alias("unique_customers"))
    return out.select(*PRODUCT_KEYS, *PRODUCT_METRICS)


def product_rates(metrics: DataFrame) -> DataFrame:
    t = F.col("total_orders")
    return (metrics
            .withColumn("order_completion_rate", guarded_ratio(F.col("completed_orders"), t))
            .withColumn("order_cancellation_rate", guarded_ratio(F.col("canceled_orders"), t))
            .withColumn("order_fraud_rate", guarded_ratio(F.col("fraud_orders"), t))
            .withColumn("order_pending_rate", guarded_ratio(F.col("pending_orders"), t))
            .withColumn("days_in_catalog", F.datediff("last_order_date", "first_order_date").cast("int")))


def _tiebreak():
    return [asc(c) for c in PRODUCT_KEYS]


def product_quantiles(enriched: DataFrame, ntile_method: str = "cuts",
                      ranges: int | None = None) -> DataFrame:
    """Metrics + rates + revenue quintile (ntile 5) and margin quartile (ntile 4)."""
    return ntile_columns(product_rates(product_metrics(enriched)), [
        ("revenue_quintile", 5, [desc("total_revenue")] + _tiebreak()),
        ("margin_quartile", 4, [desc("avg_profit_per_order")] + _tiebreak()),
    ], method=ntile_method, ranges=ranges)


def products360(enriched: DataFrame, audit: bool = False, ntile_method: str = "cuts",
                ranges: int | None = None) -> DataFrame:
    ranked = product_quantiles(enriched, ntile_method, ranges)
    t = F.col("total_orders")
    out = (ranked
           .withColumn("revenue_score", score_from_rank(F.col("revenue_quintile"), 6, t))
           .withColumn("margin_score", score_from_rank(F.col("margin_quartile"), 5, t))
           .withColumn("performance_tier", performance_tier(F.col("revenue_score")))
           .withColumn("margin_category", margin_category(F.col("margin_score")))
           .withColumn("product_health", product_health(
               F.col("performance_tier"), F.col("order_completion_rate"),
               F.col("order_cancellation_rate"), F.col("order_fraud_rate")))
           .withColumn("strategic_priority", strategic_priority(
               F.col("performance_tier"), F.col("margin_category"),
               F.col("order_cancellation_rate"), F.col("order_fraud_rate"))))
    if audit:
        out = out.withColumn("processed_at", F.current_timestamp())
    return out
