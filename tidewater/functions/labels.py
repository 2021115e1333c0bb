"""Segment and label rules of the customer and product views.

Each rule is an ordered ``when`` chain: the first matching branch wins.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Order-status groups used by the product metrics.
STATUS_COMPLETE = "COMPLETE"
STATUS_CANCELED = ["CANCELED", "CLOSED"]
STATUS_FRAUD = "SUSPECTED_FRAUD"
STATUS_PENDING = ["PENDING", "PROCESSING", "ON_HOLD", "PAYMENT_REVIEW"]

# Customer segments counted per product.
SEGMENT_CONSUMER = "Consumer"
SEGMENT_CORPORATE = "Corporate"
SEGMENT_HOME_OFFICE = "Home Office"

# recency/frequency/monetary segment labels, in rule order.
RFM_LABELS = [
    "Champions", "Loyal Customers", "Potential Loyalists", "New Customers",
    "At Risk", "Cannot Lose Them", "Hibernating", "Lost Customers",
    "Prospects", "Other",
]

# Product performance tiers and margin categories.
TIER_LABELS = ["Star Products", "Strong Performers", "Steady Performers",
               "Weak Performers", "Slow Movers"]
MARGIN_LABELS = ["High Margin", "Medium Margin", "Low Margin", "Very Low Margin"]
HEALTH_LABELS = ["Healthy", "At Risk", "Monitor"]
PRIORITY_LABELS = ["Invest & Promote", "Investigate Quality Issues",
                   "Consider Discontinuing", "Maintain"]


def rfm_segment(r: Column, f: Column, m: Column, orders: Column) -> Column:
    L = RFM_LABELS
    return (F.when((r >= 4) & (f >= 4) & (m >= 4), L[0])
            .when((r >= 3) & (f >= 3) & (m >= 3), L[1])
            .when((r >= 4) & f.between(2, 3), L[2])
            .when((r >= 4) & (f <= 1), L[3])
            .when((r <= 2) & (f >= 3) & (m >= 3), L[4])
            .when((r <= 2) & (f >= 4) & (m >= 4), L[5])   # shadowed by the rule above
            .when((r <= 2) & (f >= 2), L[6])
            .when((r <= 1) & (orders > 0), L[7])
            .when(orders == 0, L[8])
            .otherwise(L[9]))


def score_from_rank(rank: Column, top: int, orders: Column) -> Column:
    """``top - rank``; 1 for groups with no orders."""
    return F.when(orders == 0, F.lit(1)).otherwise(F.lit(top) - rank).cast("int")


def performance_tier(score: Column) -> Column:
    T = TIER_LABELS
    return (F.when(score >= 4, T[0]).when(score >= 3, T[1]).when(score >= 2, T[2])
            .when(score >= 1, T[3]).otherwise(T[4]))


def margin_category(score: Column) -> Column:
    M = MARGIN_LABELS
    return F.when(score >= 3, M[0]).when(score >= 2, M[1]).when(score >= 1, M[2]).otherwise(M[3])


def product_health(tier: Column, completion: Column, cancellation: Column, fraud: Column) -> Column:
    return (F.when(tier.isin(TIER_LABELS[0], TIER_LABELS[1]) & (completion >= 0.9) & (cancellation < 0.05),
                   HEALTH_LABELS[0])
            .when((cancellation > 0.10) | (fraud > 0.05) | (completion < 0.8), HEALTH_LABELS[1])
            .otherwise(HEALTH_LABELS[2]))


def strategic_priority(tier: Column, margin: Column, cancellation: Column, fraud: Column) -> Column:
    P = PRIORITY_LABELS
    return (F.when((tier == TIER_LABELS[0]) & (margin == MARGIN_LABELS[0]), P[0])
            .when((cancellation > 0.15) | (fraud > 0.10), P[1])
            .when((tier == TIER_LABELS[4]) & (cancellation > 0.10), P[2])
            .otherwise(P[3]))
