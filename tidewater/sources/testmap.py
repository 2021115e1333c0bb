"""Map the driver's star-schema tables onto the retail landing model.

One order line of the landing model = one ``lineitem`` row joined to its
``orders`` header, its ``part``, the ordering ``customer`` and that customer's
``nation``/``region``.  Every landing column is a pure expression of those
rows, so the result grows with the input and can be re-derived in SQL.

Two forms are produced:

* :func:`bronze_from_tables` - typed, already-clean bronze rows (what the
  landing stream would produce for defect-free files);
* :func:`raw_text_lines` - the 53 landing columns as text, with dates in all
  accepted formats and a deterministic share of defective lines, ready to be
  written as CSV files for the ingestion path.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import MONEY, RAW_COLUMNS, bronze_columns, normalize_name
from ..session import room_for, table_path

# Fixed values used by the mapping (our own definitions, documented in README).
TYPE_BY_PRIORITY = {1: "DEBIT", 2: "CASH", 3: "PAYMENT"}           # else TRANSFER
MODE_BY_PRIORITY = {1: "Same Day", 2: "First Class", 3: "Second Class"}  # else Standard Class
SEGMENT_BY_MKTSEGMENT = {"BUILDING": "Consumer", "AUTOMOBILE": "Corporate", "MACHINERY": "Corporate"}
# Defect kinds injected into the landing text, chosen by (order key + line number) mod 97.
DEFECT_MODULUS = 97
DEFECTS = {0: "zero_quantity", 1: "bad_order_date", 2: "missing_status",
           3: "zero_price", 4: "text_in_int", 5: "bad_ship_date", 6: "text_in_category"}


def _case(col: Column, mapping: dict, default) -> Column:
    expr = None
    for k, v in mapping.items():
        expr = F.when(col == k, v) if expr is None else expr.when(col == k, v)
    return expr.otherwise(default)


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem ⋈ orders ⋈ part ⋈ customer ⋈ nation ⋈ region, pruned to used columns.

    All joins are inner equi-joins on keys; Catalyst prunes every unused
    column at the parquet scan and AQE turns the joins against small sides
    (part, customer, nation, region at test scale) into broadcast joins only
    once their runtime size is known to be under the threshold.  The joins
    start with partitions by the number of lines, so no task has to sort more
    of them as the input grows.
    """
    rd = spark.read.parquet
    lines = rd(table_path(sf_dir, "lineitem"))
    room_for(spark, lines.count())                   # the count comes from the files' footers
    li = lines.select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice",
        "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate")
    od = rd(table_path(sf_dir, "orders")).select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
    pt = rd(table_path(sf_dir, "part")).select("p_partkey", "p_name", "p_brand", "p_type", "p_retailprice")
    cu = rd(table_path(sf_dir, "customer")).select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    na = rd(table_path(sf_dir, "nation")).select("n_nationkey", "n_name", "n_regionkey")
    rg = rd(table_path(sf_dir, "region")).select("r_regionkey", "r_name")
    geo = cu.join(na, cu.c_nationkey == na.n_nationkey).join(rg, na.n_regionkey == rg.r_regionkey)
    headers = od.join(geo, od.o_custkey == geo.c_custkey)        # by customer before there are lines: they move once less
    return li.join(pt, li.l_partkey == pt.p_partkey).join(headers, li.l_orderkey == od.o_orderkey)


def _model_columns(x: DataFrame) -> dict:
    """Landing column name -> typed expression over :func:`order_lines`."""
    prio = F.substring("o_orderpriority", 1, 1).cast("int")
    ship_days = F.datediff("l_shipdate", "o_orderdate").cast("int")
    late = ship_days > prio
    ext = F.col("l_extendedprice").cast("decimal(18,2)")
    disc = F.col("l_discount").cast("decimal(18,2)")
    tax = F.col("l_tax").cast("decimal(18,2)")
    discount_amt = (ext * disc).cast(MONEY)
    line_total = (ext - ext * disc).cast(MONEY)
    profit = (ext * tax).cast(MONEY)
    canceled = (F.col("o_orderstatus") == "P") & (F.col("l_returnflag") == "R")
    status = (F.when(canceled, "CANCELED")
               .when((F.col("o_orderstatus") == "P") & (F.col("l_returnflag") == "A")
                     & (F.col("l_linestatus") == "F"), "SUSPECTED_FRAUD")
               .when((F.col("o_orderstatus") == "P") & (F.col("l_returnflag") == "N")
                     & (F.col("l_linestatus") == "O"), "PENDING")
               .otherwise("COMPLETE"))
    category_id = F.substring("p_brand", 7, 10).cast("int")
    null_s, null_i, null_d = (F.lit(None).cast(t) for t in ("string", "int", "double"))
    return {
        "type": _case(prio, TYPE_BY_PRIORITY, "TRANSFER"),
        "days_for_shipping_real": ship_days,
        "days_for_shipment_scheduled": prio,
        "benefit_per_order": profit,
        "sales_per_customer": F.col("o_totalprice").cast(MONEY),
        "delivery_status": (F.when(canceled, "Shipping canceled").when(late, "Late delivery")
                             .when(ship_days < prio, "Advance shipping").otherwise("Shipping on time")),
        "late_delivery_risk": F.when(late, 1).otherwise(0),
        "category_id": category_id,
        "category_name": F.col("p_type"),
        "customer_city": null_s,
        "customer_country": F.col("n_name"),
        "customer_email": F.concat(F.lower(F.regexp_replace("c_name", "#", ".")), F.lit("@example.com")),
        "customer_fname": F.substring_index("c_name", "#", 1),
        "customer_id": F.col("c_custkey"),
        "customer_lname": F.substring_index("c_name", "#", -1),
        "customer_password": null_s,
        "customer_segment": _case(F.col("c_mktsegment"), SEGMENT_BY_MKTSEGMENT, "Home Office"),
        "customer_state": null_s,
        "customer_street": null_s,
        "customer_zipcode": F.col("c_nationkey"),
        "department_id": null_i,
        "department_name": null_s,
        "latitude": null_d,
        "longitude": null_d,
        "market": F.col("r_name"),
        "order_city": null_s,
        "order_country": F.col("n_name"),
        "order_customer_id": F.col("o_custkey"),
        "order_date_dateorders": F.col("o_orderdate"),
        "order_id": F.col("l_orderkey"),
        "order_item_cardprod_id": F.col("l_partkey"),
        "order_item_discount": discount_amt,
        "order_item_discount_rate": disc.cast(MONEY),
        "order_item_id": F.col("l_linenumber"),
        "order_item_product_price": F.col("p_retailprice").cast(MONEY),
        "order_item_profit_ratio": tax.cast(MONEY),
        "order_item_quantity": F.col("l_quantity").cast("int"),
        "sales": line_total,
        "order_item_total": line_total,
        "order_profit_per_order": profit,
        "order_region": F.col("n_name"),
        "order_state": null_s,
        "order_status": status,
        "order_zipcode": null_i,
        "product_card_id": F.col("l_partkey"),
        "product_category_id": category_id,
        "product_description": null_s,
        "product_image": null_s,
        "product_name": F.col("p_name"),
        "product_price": F.col("p_retailprice").cast(MONEY),
        "product_status": F.when(F.col("l_returnflag") == "R", 1).otherwise(0),
        "shipping_date_dateorders": F.col("l_shipdate"),
        "shipping_mode": _case(prio, MODE_BY_PRIORITY, "Standard Class"),
    }


def bronze_from_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean bronze rows (54 columns) straight from the tables.

    ``ingested_at`` - the change sequence of the history dimensions - is the
    line's ship date: each line is taken to arrive when it ships.
    """
    x = order_lines(spark, sf_dir)
    m = _model_columns(x)
    m["late_delivery_risk"] = m["late_delivery_risk"] == 1
    m["product_status"] = m["product_status"] == 1
    m["order_date_dateorders"] = F.col("o_orderdate").cast("timestamp_ntz")
    m["shipping_date_dateorders"] = F.col("l_shipdate").cast("timestamp_ntz")
    cols = [m[c].alias(c) for c in bronze_columns()]
    return x.select(*cols, F.col("l_shipdate").cast("timestamp_ntz").alias("ingested_at"))


def _fmt_date(ts: Column, kind: Column) -> Column:
    """Date text in one of the three accepted layouts, picked by ``kind``."""
    return (F.when(kind == 0, F.date_format(ts, "M/d/yyyy H:mm"))
             .when(kind == 1, F.date_format(ts, "MM/dd/yyyy HH:mm"))
             .otherwise(F.date_format(ts, "dd-MM-yyyy HH:mm")))


def defect_kind(x: DataFrame | None = None) -> Column:
    """Defect injected into a landing line (null = clean line)."""
    k = F.pmod(F.col("l_orderkey") + F.col("l_linenumber"), F.lit(DEFECT_MODULUS))
    return _case(k, DEFECTS, F.lit(None).cast("string"))


def raw_text_lines(spark: SparkSession, sf_dir: str, defects: bool = True) -> DataFrame:
    """The 53 landing columns as text (normalised names), in file order."""
    x = order_lines(spark, sf_dir)
    m = _model_columns(x)
    kind = defect_kind() if defects else F.lit(None).cast("string")
    fmt = F.pmod(F.col("l_orderkey"), F.lit(3))
    text = {c: e.cast("string") for c, e in m.items()}
    text["order_date_dateorders"] = _fmt_date(F.col("o_orderdate"), fmt)
    text["shipping_date_dateorders"] = _fmt_date(F.col("l_shipdate"), fmt)
    broken = {
        "zero_quantity": ("order_item_quantity", F.lit("0")),
        "bad_order_date": ("order_date_dateorders", F.date_format("o_orderdate", "yyyy-MM-dd")),
        "missing_status": ("order_status", F.lit(None).cast("string")),
        "zero_price": ("order_item_product_price", F.lit("0.0000")),
        "text_in_int": ("order_id", F.concat(F.lit("X"), F.col("l_orderkey").cast("string"))),
        "text_in_category": ("category_id", F.lit("n/a")),       # no rule reads this column
        "bad_ship_date": ("shipping_date_dateorders", F.lit("not a date")),
    }
    for name, (column, value) in broken.items():
        text[column] = F.when(kind == name, value).otherwise(text[column])
    names = [normalize_name(n) for n, _ in RAW_COLUMNS]
    return x.select(*[text[c].alias(c) for c in names])
