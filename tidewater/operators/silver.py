"""Silver projections of bronze: customers, products, orders.

Pure projections (rename + pick), so on a stream they are stateless and on
parquet they prune the scan to the columns picked.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import SILVER_ORDER_COLUMNS

SEQ = "transformed_at"

#: Order of changes that share a sequence value (one file carries many): order date, then order and item id.
CHANGE_ORDER = {"_change_date": "order_date_dateorders", "_change_order": "order_id", "_change_item": "order_item_id"}


def _change_order(ordered: bool) -> list:
    return [F.col(src).alias(dst) for dst, src in CHANGE_ORDER.items()] if ordered else []


def _audit(df: DataFrame, name: str, audit: bool) -> DataFrame:
    return df.withColumn(name, F.current_timestamp()) if audit else df


def silver_customers(bronze: DataFrame, sequence_col: str = "ingested_at", ordered: bool = False) -> DataFrame:
    """Customer change rows.  ``transformed_at`` is the change sequence;
    ``ordered`` adds the columns that order changes within it.

    The e-mail leaves bronze only as its SHA-256 hash; the password never does.
    """
    return bronze.select(
        F.col("customer_id"),
        F.col("customer_fname").alias("customer_firstname"),
        F.col("customer_lname").alias("customer_lastname"),
        F.col("customer_segment"),
        F.sha2(F.col("customer_email"), 256).alias("email_masked"),
        F.lit(None).cast("string").alias("password_masked"),
        F.col("customer_zipcode"),
        F.col(sequence_col).alias(SEQ),
        *_change_order(ordered),
    )


def silver_products(bronze: DataFrame, sequence_col: str = "ingested_at", ordered: bool = False) -> DataFrame:
    return bronze.select(
        F.col("product_card_id").alias("product_id"),
        F.col("category_id"),
        F.col("category_name"),
        F.col("product_name"),
        F.col("product_price"),
        F.col("product_status").alias("is_notavailable"),
        F.col(sequence_col).alias(SEQ),
        *_change_order(ordered),
    )


def silver_orders(bronze: DataFrame, audit: bool = False) -> DataFrame:
    out = bronze.select(*[F.col(src).alias(dst) for src, dst in SILVER_ORDER_COLUMNS])
    return _audit(out, "processed_at", audit)
