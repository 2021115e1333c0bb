"""Data-quality rules: keep, quarantine and count failures.

A line is kept only when every rule is TRUE; a rule that evaluates to NULL
counts as a failure.  Rules are plain SQL predicates, evaluated on the cleaned
bronze columns, so they fuse into the scan's codegen stage.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import CORRUPT_COL

# Rule name -> predicate (all must hold for a line to be kept).
RULES = {
    "valid_type": "type IS NOT NULL",
    "valid_customer_id": "customer_id IS NOT NULL",
    "valid_order_id": "order_id IS NOT NULL",
    "valid_order_item_id": "order_item_cardprod_id IS NOT NULL",
    "valid_order_date": "order_date_dateorders IS NOT NULL",
    "valid_product_id": "product_card_id IS NOT NULL",
    "valid_order_status": "order_status IS NOT NULL",
    "valid_shipping_mode": "shipping_mode IS NOT NULL",
    "valid_delivery_status": "delivery_status IS NOT NULL",
    "valid_market": "market IS NOT NULL",
    "valid_region": "order_region IS NOT NULL",
    "valid_quantity": "order_item_quantity IS NOT NULL AND order_item_quantity > 0",
    "valid_price": "order_item_product_price IS NOT NULL AND order_item_product_price > 0",
}


def rule_passes(rule: str) -> Column:
    return F.coalesce(F.expr(RULES[rule]), F.lit(False))


def all_rules_pass(rules=None) -> Column:
    rules = list(rules or RULES)
    cond = rule_passes(rules[0])
    for r in rules[1:]:
        cond = cond & rule_passes(r)
    return cond


def _well_formed(df: DataFrame) -> Column:
    return F.col(CORRUPT_COL).isNull() if CORRUPT_COL in df.columns else F.lit(True)


def expect_or_drop(df: DataFrame, rules=None) -> DataFrame:
    """Lines that parse and satisfy every rule; the rescue column is dropped."""
    out = df.filter(_well_formed(df) & all_rules_pass(rules))
    return out.drop(CORRUPT_COL) if CORRUPT_COL in df.columns else out


def failed_rules(rules=None) -> Column:
    """Array of the names of the rules a line fails (empty when it passes)."""
    names = list(rules or RULES)
    return F.filter(F.array(*[F.when(~rule_passes(r), F.lit(r)) for r in names]),
                    lambda x: x.isNotNull())


def quarantine(df: DataFrame, rules=None) -> DataFrame:
    """Lines that do not fit the schema or fail a rule, with the reasons."""
    reasons = failed_rules(rules)
    if CORRUPT_COL in df.columns:
        reasons = F.when(F.col(CORRUPT_COL).isNotNull(),
                         F.array_insert(reasons, 1, F.lit("malformed"))).otherwise(reasons)
    return (df.withColumn("failed_rules", reasons)
              .filter(F.size("failed_rules") > 0))


def rule_metric_columns(rules=None) -> list[Column]:
    cols = [F.count("*").alias("input_rows")]
    for r in list(rules or RULES):
        cols.append(F.count_if(~rule_passes(r)).alias(r))
    return cols


def rule_failure_counts(df: DataFrame, rules=None) -> DataFrame:
    """One row: input rows and the number of lines failing each rule.

    A single global aggregate: each task emits one partial row, so the final
    merge handles one row per task no matter how large the input is.
    """
    cols = rule_metric_columns(rules)
    if CORRUPT_COL in df.columns:
        cols.insert(1, F.count_if(F.col(CORRUPT_COL).isNotNull()).alias("malformed"))
    return df.agg(*cols)
