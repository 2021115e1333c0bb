"""Schemas of the landing files and of every table the pipeline writes."""

from __future__ import annotations

from pyspark.sql.types import (BooleanType, DecimalType, DoubleType, IntegerType,
                               LongType, StringType, StructField, StructType,
                               TimestampNTZType)

# Money is carried as an exact decimal so that sums do not depend on the order
# in which partitions are combined (the landing format writes plain decimals).
MONEY = DecimalType(18, 4)

# The landing CSV header, in file order (53 columns), with the
# type each column is read as.  Ids are read as 64-bit integers.
RAW_COLUMNS = [
    ("Type", StringType()),
    ("Days for shipping (real)", IntegerType()),
    ("Days for shipment (scheduled)", IntegerType()),
    ("Benefit per order", MONEY),
    ("Sales per customer", MONEY),
    ("Delivery Status", StringType()),
    ("Late_delivery_risk", IntegerType()),
    ("Category Id", IntegerType()),
    ("Category Name", StringType()),
    ("Customer City", StringType()),
    ("Customer Country", StringType()),
    ("Customer Email", StringType()),
    ("Customer Fname", StringType()),
    ("Customer Id", LongType()),
    ("Customer Lname", StringType()),
    ("Customer Password", StringType()),
    ("Customer Segment", StringType()),
    ("Customer State", StringType()),
    ("Customer Street", StringType()),
    ("Customer Zipcode", IntegerType()),
    ("Department Id", IntegerType()),
    ("Department Name", StringType()),
    ("Latitude", DoubleType()),
    ("Longitude", DoubleType()),
    ("Market", StringType()),
    ("Order City", StringType()),
    ("Order Country", StringType()),
    ("Order Customer Id", LongType()),
    ("order date (DateOrders)", StringType()),
    ("Order Id", LongType()),
    ("Order Item Cardprod Id", LongType()),
    ("Order Item Discount", MONEY),
    ("Order Item Discount Rate", MONEY),
    ("Order Item Id", LongType()),
    ("Order Item Product Price", MONEY),
    ("Order Item Profit Ratio", MONEY),
    ("Order Item Quantity", IntegerType()),
    ("Sales", MONEY),
    ("Order Item Total", MONEY),
    ("Order Profit Per Order", MONEY),
    ("Order Region", StringType()),
    ("Order State", StringType()),
    ("Order Status", StringType()),
    ("Order Zipcode", IntegerType()),
    ("Product Card Id", LongType()),
    ("Product Category Id", IntegerType()),
    ("Product Description", StringType()),
    ("Product Image", StringType()),
    ("Product Name", StringType()),
    ("Product Price", MONEY),
    ("Product Status", IntegerType()),
    ("shipping date (DateOrders)", StringType()),
    ("Shipping Mode", StringType()),
]

RAW_HEADERS = [name for name, _ in RAW_COLUMNS]

# Column holding the raw text of a line that did not fit the schema.
CORRUPT_COL = "_rescued_record"

DATE_COLS = ["order_date_dateorders", "shipping_date_dateorders"]
BOOL_COLS = ["late_delivery_risk", "product_status"]


def normalize_name(name: str) -> str:
    """Landing header -> column name: drop ()[]{}, trim, lower, space -> _."""
    for ch in "()[]{}":
        name = name.replace(ch, "")
    return name.strip().lower().replace(" ", "_")


def raw_schema(with_corrupt: bool = True) -> StructType:
    """Typed landing schema, bound by position, with normalised names."""
    fields = [StructField(normalize_name(n), t, True) for n, t in RAW_COLUMNS]
    if with_corrupt:
        fields.append(StructField(CORRUPT_COL, StringType(), True))
    return StructType(fields)


def raw_text_schema() -> StructType:
    """Landing lines as text under their header names, with the raw line of those of a wrong length."""
    return StructType([*[StructField(n, StringType(), True) for n, _ in RAW_COLUMNS],
                       StructField(CORRUPT_COL, StringType(), True)])


def bronze_columns() -> list[str]:
    """Bronze order: untouched columns first, then the four cleaned ones."""
    names = [normalize_name(n) for n in RAW_HEADERS]
    moved = DATE_COLS + BOOL_COLS
    return [n for n in names if n not in moved] + moved


def bronze_types() -> dict:
    types = {normalize_name(n): t for n, t in RAW_COLUMNS}
    for c in DATE_COLS:
        types[c] = TimestampNTZType()
    for c in BOOL_COLS:
        types[c] = BooleanType()
    return types


def bronze_schema() -> StructType:
    types = bronze_types()
    fields = [StructField(c, types[c], True) for c in bronze_columns()]
    fields.append(StructField("ingested_at", TimestampNTZType(), True))
    return StructType(fields)


# silver_orders: (bronze column, silver name), in table order.
SILVER_ORDER_COLUMNS = [
    ("order_id", "order_id"),
    ("order_customer_id", "customer_id"),
    ("order_item_cardprod_id", "product_id"),
    ("order_item_id", "item_id"),
    ("order_date_dateorders", "order_date"),
    ("order_item_product_price", "product_price"),
    ("order_item_quantity", "quantity"),
    ("order_item_total", "line_total"),
    ("sales", "sales"),
    ("sales_per_customer", "sales_per_customer"),
    ("order_item_discount", "discount"),
    ("order_item_discount_rate", "discount_rate"),
    ("order_item_profit_ratio", "profit_ratio"),
    ("order_profit_per_order", "profit_per_order"),
    ("type", "transaction_method"),
    ("order_status", "order_status"),
    ("department_id", "store_dept_id"),
    ("department_name", "store_dept_name"),
    ("customer_city", "store_city"),
    ("customer_state", "store_state"),
    ("customer_country", "store_country"),
    ("customer_street", "store_street"),
    ("latitude", "store_latitude"),
    ("longitude", "store_longitude"),
    ("market", "delivery_market"),
    ("order_city", "delivery_city"),
    ("order_state", "delivery_state"),
    ("order_country", "delivery_country"),
    ("order_region", "delivery_region"),
    ("days_for_shipping_real", "actual_shipping_days"),
    ("days_for_shipment_scheduled", "scheduled_shipping_days"),
    ("delivery_status", "delivery_status"),
    ("late_delivery_risk", "late_delivery_risk"),
    ("shipping_mode", "shipping_mode"),
    ("shipping_date_dateorders", "shipping_date"),
]

CUSTOMER_DIM_KEYS = ["customer_id"]
CUSTOMER_TRACKED = ["customer_segment", "customer_zipcode"]
PRODUCT_DIM_KEYS = ["product_id"]
PRODUCT_TRACKED = ["is_notavailable"]

SCD_START = "__START_AT"
SCD_END = "__END_AT"
