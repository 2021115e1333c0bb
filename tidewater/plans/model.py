"""The medallion over the driver's tables: bronze -> silver -> dims -> gold.

``Medallion`` builds each layer lazily from the one below.  Where several
layers read bronze it is written once to the shared folder; a query of one
layer leaves it lazy (``materialize_bronze=False``), so column pruning reaches
the source tables.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from ..operators import silver as S
from ..operators.rules import expect_or_drop
from ..operators.scd2 import current, scd2
from ..schemas import CUSTOMER_DIM_KEYS, CUSTOMER_TRACKED, PRODUCT_DIM_KEYS, PRODUCT_TRACKED
from ..sinks.tables import file_slices, materialize, materialize_slices
from ..sources.testmap import bronze_from_tables
from .customers import customers360
from .enrich import LINES_AT_ONCE, orders_enriched, stored_dimensions
from .products import products360


def tiebreak(changes: DataFrame, keys: list[str], tracked: list[str]) -> list[str]:
    """Order of changes with an equal sequence: order date and ids, then the row's content."""
    rest = [c for c in changes.columns if c not in (*S.CHANGE_ORDER, *keys, *tracked, S.SEQ)]
    return [*S.CHANGE_ORDER, *tracked, *rest]


def customer_history(bronze: DataFrame) -> DataFrame:
    changes = S.silver_customers(bronze, ordered=True)
    order = tiebreak(changes, CUSTOMER_DIM_KEYS, CUSTOMER_TRACKED)
    return scd2(changes, CUSTOMER_DIM_KEYS, S.SEQ, CUSTOMER_TRACKED, order).drop(*S.CHANGE_ORDER)


def product_history(bronze: DataFrame) -> DataFrame:
    changes = S.silver_products(bronze, ordered=True)
    order = tiebreak(changes, PRODUCT_DIM_KEYS, PRODUCT_TRACKED)
    return scd2(changes, PRODUCT_DIM_KEYS, S.SEQ, PRODUCT_TRACKED, order).drop(*S.CHANGE_ORDER)


class Medallion:
    def __init__(self, spark: SparkSession, sf_dir: str, materialize_bronze: bool = True,
                 ntile_method: str = "cuts", ntile_ranges: int | None = None):
        self.spark = spark
        self.sf_dir = sf_dir
        self.materialize_bronze = materialize_bronze
        self.ntile_method = ntile_method
        self.ntile_kw = {"ranges": ntile_ranges}

    @cached_property
    def bronze(self) -> DataFrame:
        df = expect_or_drop(bronze_from_tables(self.spark, self.sf_dir))
        return materialize(self.spark, df, "bronze") if self.materialize_bronze else df

    @property
    def silver_orders(self) -> DataFrame:
        return S.silver_orders(self.bronze)

    @property
    def silver_customers(self) -> DataFrame:
        return S.silver_customers(self.bronze)

    @property
    def silver_products(self) -> DataFrame:
        return S.silver_products(self.bronze)

    @property
    def dim_customers(self) -> DataFrame:
        return customer_history(self.bronze)

    @property
    def dim_products(self) -> DataFrame:
        return product_history(self.bronze)

    @property
    def orders_enriched(self) -> DataFrame:
        """Lazy, over lazy dimensions: a reader that needs neither of them computes neither."""
        return orders_enriched(self.silver_orders, current(self.dim_customers), current(self.dim_products))

    @cached_property
    def dimensions(self) -> tuple[DataFrame, DataFrame]:
        return stored_dimensions(current(self.dim_customers), current(self.dim_products))

    @property
    def enriched_lines(self) -> DataFrame:
        """``orders_enriched`` over stored dimensions, for readers of some of its columns."""
        return orders_enriched(self.silver_orders, *self.dimensions)

    @property
    def stored_orders_enriched(self) -> DataFrame:
        """``orders_enriched`` with all its columns; more than ``LINES_AT_ONCE`` lines are joined and stored in slices."""
        parts = [orders_enriched(S.silver_orders(b), *self.dimensions) for b in file_slices(self.bronze, LINES_AT_ONCE)]
        return parts[0] if len(parts) == 1 else materialize_slices(self.spark, parts, "orders-enriched")

    def customers360(self) -> DataFrame:
        return customers360(self.enriched_lines, ntile_method=self.ntile_method, **self.ntile_kw)

    def products360(self) -> DataFrame:
        return products360(self.enriched_lines, ntile_method=self.ntile_method, **self.ntile_kw)
