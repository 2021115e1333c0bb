"""Test loads as Spark jobs: synthetic order lines and change loads.

Every value is a pure function of (row id, seed, column): executors generate
their own rows, the result does not depend on partitioning, and the same
seed gives the same rows on any cluster.  Written out as many CSV files.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import RAW_HEADERS, normalize_name

# Value domains of the synthetic loads.
TRANSACTION_TYPES = ["DEBIT", "CASH", "PAYMENT", "TRANSFER"]
CUSTOMER_SEGMENTS = ["Consumer", "Corporate", "Home Office"]
MARKETS = ["Africa", "Europe", "LATAM", "Pacific Asia", "USCA"]
SHIPPING_MODES = ["Standard Class", "First Class", "Second Class", "Same Day"]
CATEGORIES = ["Electronics", "Clothing", "Books", "Home & Garden", "Sports & Outdoors",
              "Toys & Games", "Health & Beauty", "Automotive", "Grocery", "Office Supplies"]
DEPARTMENTS = ["Sales", "Marketing", "Operations", "Customer Service", "Warehouse", "IT", "Finance"]
ORDER_REGIONS = [
    "Southeast Asia", "South Asia", "Oceania", "Eastern Asia", "West Asia", "West of USA",
    "US Center", "West Africa", "Central Africa", "North Africa", "Western Europe",
    "Northern Europe", "Caribbean", "South America", "East Africa", "Southern Europe",
    "East of USA", "Canada", "Southern Africa", "Central Asia", "Central America",
    "Eastern Europe", "South of USA",
]
PRODUCT_NAMES = {
    "Electronics": ["Laptop", "Smartphone", "Tablet", "Headphones", "Smart Watch"],
    "Clothing": ["T-Shirt", "Jeans", "Dress", "Jacket", "Shoes"],
    "Books": ["Fiction Novel", "Textbook", "Cookbook", "Biography"],
    "Home & Garden": ["Furniture Set", "Garden Tools", "Kitchen Appliance", "Lamp"],
    "Sports & Outdoors": ["Bicycle", "Tent", "Yoga Mat", "Running Shoes"],
    "Toys & Games": ["Board Game", "Action Figure", "Puzzle", "Doll"],
    "Health & Beauty": ["Skincare Set", "Makeup Kit", "Vitamins", "Perfume"],
    "Automotive": ["Car Parts", "Tools", "GPS Device", "Tire"],
    "Grocery": ["Snack Pack", "Beverage Set", "Organic Food", "Coffee"],
    "Office Supplies": ["Desk Chair", "Notebook Set", "Printer", "Pen Set"],
}
# Our own small name pools (no identity library).
FIRST_NAMES = ["Ana", "Ben", "Chloe", "Dev", "Emil", "Fatima", "Goran", "Hana", "Ivo", "June",
               "Kofi", "Lena", "Marco", "Nora", "Omar", "Pia", "Quinn", "Rosa", "Sami", "Tess"]
LAST_NAMES = ["Adler", "Brandt", "Costa", "Dumas", "Eriksen", "Fischer", "Garcia", "Hughes",
              "Ito", "Jensen", "Kowalski", "Lopez", "Moreau", "Novak", "Okafor", "Petrov"]
CITIES = ["Springfield", "Riverton", "Lakeside", "Fairview", "Georgetown", "Oakdale", "Milford",
          "Ashland", "Clinton", "Dover"]
STATES = ["CA", "TX", "NY", "FL", "IL", "PA", "OH", "GA", "NC", "MI"]
YEAR_START = "2018-01-01 00:00:00"
SECONDS_IN_YEAR = 365 * 86400


def _u(row_id: Column, seed: int, salt: str) -> Column:
    """Uniform integer in [0, 2^62): hash of (row id, seed, column name)."""
    return F.pmod(F.xxhash64(row_id, F.lit(seed), F.lit(salt)), F.lit(1 << 62))


def _pick(row_id, seed, salt, values: list) -> Column:
    arr = F.array(*[F.lit(v) for v in values])
    return F.element_at(arr, (F.pmod(_u(row_id, seed, salt), F.lit(len(values))) + 1).cast("int"))


def _int_between(row_id, seed, salt, lo: int, hi: int) -> Column:
    return (F.lit(lo) + F.pmod(_u(row_id, seed, salt), F.lit(hi - lo + 1))).cast("int")


def _uniform(row_id, seed, salt, lo: float, hi: float, scale: int) -> Column:
    steps = int(round((hi - lo) * 10 ** scale))
    k = F.pmod(_u(row_id, seed, salt), F.lit(steps + 1))
    return (F.lit(lo) + k / F.lit(10 ** scale)).cast(f"decimal(18,{scale})")


def synthetic_lines(ids: DataFrame, seed: int = 42, id_col: str = "id", id_offset: int = 0,
                    given: dict[str, Column] | None = None) -> DataFrame:
    """One landing line (53 typed columns, normalised names) per row of ``ids``.

    ``given``: landing columns taken from ``ids`` instead of being drawn.
    """
    i = F.col(id_col)
    cat_idx = F.pmod(_u(i, seed, "category"), F.lit(len(CATEGORIES)))
    category = F.element_at(F.array(*[F.lit(c) for c in CATEGORIES]), (cat_idx + 1).cast("int"))
    names_by_cat = F.create_map(*[x for c in CATEGORIES
                                  for x in (F.lit(c), F.array(*[F.lit(n) for n in PRODUCT_NAMES[c]]))])
    pname_arr = F.element_at(names_by_cat, category)
    product_name = F.element_at(pname_arr, (F.pmod(_u(i, seed, "pname"), F.size(pname_arr)) + 1).cast("int"))
    price = _uniform(i, seed, "price", 10.0, 2000.0, 2)
    discount = (price * 0.3 * (F.pmod(_u(i, seed, "disc"), F.lit(10001)) / 10000)).cast("decimal(18,2)")
    qty = _int_between(i, seed, "qty", 1, 10)
    total = ((price - discount) * qty).cast("decimal(18,2)")
    ratio = _uniform(i, seed, "ratio", 0.1, 0.4, 4)
    profit = (total * ratio).cast("decimal(18,2)")
    mode = _pick(i, seed, "mode", SHIPPING_MODES)
    sched = (F.when(mode == "Same Day", F.lit(1))
              .when(mode == "First Class", _int_between(i, seed, "sched", 2, 3))
              .when(mode == "Second Class", _int_between(i, seed, "sched", 4, 6))
              .otherwise(_int_between(i, seed, "sched", 5, 10)))
    actual = F.greatest(F.lit(1), sched + _int_between(i, seed, "delay", -1, 3))
    late = (actual > sched).cast("int")
    other = F.pmod(_u(i, seed, "dstatus"), F.lit(20))           # 10 %: canceled or advance
    delivery = (F.when(late == 1, "Late delivery")
                 .when(other == 0, "Shipping canceled").when(other == 1, "Advance shipping")
                 .otherwise("Shipping on time"))
    status = (F.when(delivery == "Shipping canceled", "CANCELED")
               .when(delivery == "Late delivery", _pick(i, seed, "st_late", ["PENDING", "PROCESSING", "ON_HOLD"]))
               .otherwise(_pick(i, seed, "st", ["COMPLETE", "COMPLETE", "COMPLETE", "PENDING", "CLOSED"])))
    # wall-clock arithmetic on timestamp_ntz: independent of the session time zone
    order_ts = (F.lit(YEAR_START).cast("timestamp_ntz")
                + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0),
                                     F.pmod(_u(i, seed, "odate"), F.lit(SECONDS_IN_YEAR))))
    ship_ts = order_ts + F.make_dt_interval(actual)
    customer_id = _int_between(i, seed, "cust", 1000, 9999).cast("long")
    product_id = _int_between(i, seed, "prod", 1000, 9999).cast("long")
    dept = _int_between(i, seed, "dept", 1, len(DEPARTMENTS))
    fname = _pick(i, seed, "fname", FIRST_NAMES)
    lname = _pick(i, seed, "lname", LAST_NAMES)
    cols = {
        "type": _pick(i, seed, "type", TRANSACTION_TYPES),
        "days_for_shipping_real": actual,
        "days_for_shipment_scheduled": sched,
        "benefit_per_order": profit,
        "sales_per_customer": _uniform(i, seed, "spc", 100.0, 5000.0, 2),
        "delivery_status": delivery,
        "late_delivery_risk": late,
        "category_id": (cat_idx + 1).cast("int"),
        "category_name": category,
        "customer_city": _pick(i, seed, "ccity", CITIES),
        "customer_country": F.lit("United States"),
        "customer_email": F.concat(F.lower(F.concat_ws(".", fname, lname, customer_id.cast("string"))),
                                   F.lit("@example.com")),
        "customer_fname": fname,
        "customer_id": customer_id,
        "customer_lname": lname,
        "customer_password": F.substring(F.sha2(F.concat(i.cast("string"), F.lit(str(seed))), 256), 1, 12),
        "customer_segment": _pick(i, seed, "segment", CUSTOMER_SEGMENTS),
        "customer_state": _pick(i, seed, "cstate", STATES),
        "customer_street": F.concat(_int_between(i, seed, "street", 1, 9999).cast("string"), F.lit(" Main St")),
        "customer_zipcode": _int_between(i, seed, "zip", 10000, 99999),
        "department_id": dept,
        "department_name": F.element_at(F.array(*[F.lit(d) for d in DEPARTMENTS]), dept),
        "latitude": (F.pmod(_u(i, seed, "lat"), F.lit(1800001)) / 10000 - 90).cast("double"),
        "longitude": (F.pmod(_u(i, seed, "lon"), F.lit(3600001)) / 10000 - 180).cast("double"),
        "market": _pick(i, seed, "market", MARKETS),
        "order_city": _pick(i, seed, "ocity", CITIES),
        "order_country": F.lit("United States"),
        "order_customer_id": customer_id,
        "order_date_dateorders": F.date_format(order_ts, "MM/dd/yyyy HH:mm"),
        "order_id": (F.lit(10000 + id_offset) + i).cast("long"),
        "order_item_cardprod_id": product_id,
        "order_item_discount": discount,
        "order_item_discount_rate": F.when(price > 0, (discount / price).cast("decimal(18,4)")).otherwise(0),
        "order_item_id": (F.lit(20000 + id_offset) + i).cast("long"),
        "order_item_product_price": price,
        "order_item_profit_ratio": ratio,
        "order_item_quantity": qty,
        "sales": total,
        "order_item_total": total,
        "order_profit_per_order": profit,
        "order_region": _pick(i, seed, "region", ORDER_REGIONS),
        "order_state": _pick(i, seed, "ostate", STATES),
        "order_status": status,
        "order_zipcode": _int_between(i, seed, "ozip", 10000, 99999),
        "product_card_id": product_id,
        "product_category_id": (cat_idx + 1).cast("int"),
        "product_description": F.concat(product_name, F.lit(" - High quality "), F.lower(category),
                                        F.lit(" product")),
        "product_image": F.concat(F.lit("http://example.com/images/product_"), product_id.cast("string"),
                                  F.lit(".jpg")),
        "product_name": product_name,
        "product_price": price,
        "product_status": _int_between(i, seed, "pstatus", 0, 1),
        "shipping_date_dateorders": F.date_format(ship_ts, "MM/dd/yyyy HH:mm"),
        "shipping_mode": mode,
    }
    cols.update(given or {})
    names = [normalize_name(h) for h in RAW_HEADERS]
    return ids.select(*[cols[c].alias(c) for c in names])


def generate(spark: SparkSession, n: int, seed: int = 42, partitions: int | None = None,
             id_offset: int = 0) -> DataFrame:
    """``n`` synthetic lines generated by executors (``spark.range``)."""
    ids = spark.range(0, n, 1, partitions) if partitions else spark.range(0, n)
    return synthetic_lines(ids, seed, id_offset=id_offset)


def choose_customers(lines: DataFrame, k: int, seed: int = 42) -> DataFrame:
    """k distinct customers, picked by a seeded hash order (a sampling operator).

    ``(id mod p) * a mod p`` keeps the arithmetic inside 64 bits for any id.
    """
    p, a = 4294967291, 40503
    ids = lines.select("customer_id").where(F.col("customer_id").isNotNull()).distinct()
    h = F.pmod(F.pmod(F.col("customer_id") + F.lit(seed), F.lit(p)) * F.lit(a), F.lit(p))
    return ids.orderBy(h, F.col("customer_id")).limit(k)


def change_load(lines: DataFrame, k: int, seed: int = 42) -> DataFrame:
    """All lines of k chosen customers with product status flipped, the
    segment moved to the next one in the segment list and a new zip code."""
    chosen = choose_customers(lines, k, seed)
    rows = lines.join(chosen, "customer_id", "left_semi")
    segs = F.array(*[F.lit(s) for s in CUSTOMER_SEGMENTS])
    pos = F.array_position(segs, F.col("customer_segment"))
    next_seg = F.element_at(segs, (F.pmod(pos, F.lit(len(CUSTOMER_SEGMENTS))) + 1).cast("int"))
    status = F.col("product_status")
    flipped = ~status if _is_bool(rows, "product_status") else (F.lit(1) - status).cast("int")
    return (rows.withColumn("product_status", flipped)
                .withColumn("customer_segment", F.coalesce(next_seg, F.lit(CUSTOMER_SEGMENTS[0])))
                .withColumn("customer_zipcode", (F.col("customer_zipcode") + F.lit(1)).cast("int"))
                .select(*lines.columns))


def _is_bool(df: DataFrame, c: str) -> bool:
    return df.schema[c].dataType.typeName() == "boolean"


def write_test_loads(spark: SparkSession, landing_dir: str, n: int, k: int = 5, seed: int = 42,
                     load_id: str | None = None, partitions: int | None = None) -> str:
    """Two landing folders under one unique prefix: a base load of ``n`` lines,
    then a change load of every line of ``k`` customers of that base load.

    The change load is written after the base load, so its files arrive later
    (the history orders changes by file arrival).  Returns a path glob that
    covers both folders for the landing readers.
    """
    import uuid

    from ..sinks.tables import write_csv
    prefix = load_id or uuid.uuid4().hex
    base = generate(spark, n, seed, partitions)
    write_csv(base.toDF(*RAW_HEADERS), f"{landing_dir}/{prefix}_synthetic_incremental_load")
    changes = change_load(base, k, seed)
    write_csv(changes.toDF(*RAW_HEADERS), f"{landing_dir}/{prefix}_synthetic_incremental_load_scd2")
    return f"{landing_dir}/*"
