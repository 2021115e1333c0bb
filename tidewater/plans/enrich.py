"""orders_enriched: every order line with its current customer and product."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sinks.tables import materialize

CUSTOMER_ATTRS = ["customer_firstname", "customer_lastname", "customer_segment", "customer_zipcode"]
PRODUCT_ATTRS = ["product_name", "category_id", "category_name", "is_notavailable"]

#: Lines that are joined at once where the result is stored: their two shuffles take about 250 bytes a line.
LINES_AT_ONCE = 20_000_000


def stored_dimensions(customers_current: DataFrame, products_current: DataFrame) -> tuple[DataFrame, DataFrame]:
    """What lines take from the dimensions, stored: the histories' shuffle files are gone before lines are joined, and
    the joins are planned with the dimensions' sizes."""
    spark = customers_current.sparkSession
    return (materialize(spark, customers_current.select("customer_id", *CUSTOMER_ATTRS), "current-customers"),
            materialize(spark, products_current.select("product_id", *PRODUCT_ATTRS), "current-products"))


def orders_enriched(orders: DataFrame, customers_current: DataFrame,
                    products_current: DataFrame, audit: bool = False) -> DataFrame:
    """orders ⟕ current customers ⟕ current products (unmatched lines kept).

    Both dimension sides hold one open version per key, so the left joins
    never multiply lines.  No broadcast hint: the dimensions grow with the
    data, and AQE switches a join to broadcast only after measuring the
    dimension's materialised size against ``autoBroadcastJoinThreshold``;
    beyond it the join stays sort-merge, with AQE splitting skewed keys.
    """
    c = customers_current.select("customer_id", *CUSTOMER_ATTRS)
    p = products_current.select("product_id", *PRODUCT_ATTRS)
    o_cols = orders.columns
    step1 = (orders.alias("o")
             .join(c.alias("c"), F.col("o.customer_id") == F.col("c.customer_id"), "left")
             .select(*[F.col(f"o.{x}") for x in o_cols], *[F.col(f"c.{x}") for x in CUSTOMER_ATTRS]))
    step2 = (step1.alias("o")
             .join(p.alias("p"), F.col("o.product_id") == F.col("p.product_id"), "left")
             .select(*[F.col(f"o.{x}") for x in step1.columns], *[F.col(f"p.{x}") for x in PRODUCT_ATTRS]))
    return step2.withColumn("enriched_at", F.current_timestamp()) if audit else step2
