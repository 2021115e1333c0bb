"""Independent SQL (DuckDB dialect) for every registered query.

Written from the definitions, not from the Spark code: where the Spark plan
is restructured for scale (one aggregation instead of distinct + join,
pieces + summaries instead of a per-key window, range-split ntile) the SQL
here follows the plain textbook form, so a match checks the rewrite.
Tables are the driver's pre-registered views.
"""

from __future__ import annotations

MONEY = "DECIMAL(18,4)"

RULES_SQL = [
    "type IS NOT NULL", "customer_id IS NOT NULL", "order_id IS NOT NULL",
    "order_item_cardprod_id IS NOT NULL", "order_date_dateorders IS NOT NULL",
    "product_card_id IS NOT NULL", "order_status IS NOT NULL", "shipping_mode IS NOT NULL",
    "delivery_status IS NOT NULL", "market IS NOT NULL", "order_region IS NOT NULL",
    "order_item_quantity IS NOT NULL AND order_item_quantity > 0",
    "order_item_product_price IS NOT NULL AND order_item_product_price > 0",
]
RULE_NAMES = [
    "valid_type", "valid_customer_id", "valid_order_id", "valid_order_item_id",
    "valid_order_date", "valid_product_id", "valid_order_status", "valid_shipping_mode",
    "valid_delivery_status", "valid_market", "valid_region", "valid_quantity", "valid_price",
]

LINES = """
SELECT * FROM lineitem
JOIN orders ON l_orderkey = o_orderkey
JOIN part ON l_partkey = p_partkey
JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey
"""

# typed landing columns of every order line
MODEL = f"""
SELECT
  CASE prio WHEN 1 THEN 'DEBIT' WHEN 2 THEN 'CASH' WHEN 3 THEN 'PAYMENT' ELSE 'TRANSFER' END AS type,
  ship_days AS days_for_shipping_real,
  prio AS days_for_shipment_scheduled,
  CAST(ext * tax AS {MONEY}) AS benefit_per_order,
  CAST(o_totalprice AS {MONEY}) AS sales_per_customer,
  CASE WHEN o_orderstatus = 'P' AND l_returnflag = 'R' THEN 'Shipping canceled'
       WHEN ship_days > prio THEN 'Late delivery'
       WHEN ship_days < prio THEN 'Advance shipping'
       ELSE 'Shipping on time' END AS delivery_status,
  CASE WHEN ship_days > prio THEN 1 ELSE 0 END AS late_delivery_risk,
  CAST(substr(p_brand, 7, 10) AS INTEGER) AS category_id,
  p_type AS category_name,
  CAST(NULL AS VARCHAR) AS customer_city,
  n_name AS customer_country,
  lower(replace(c_name, '#', '.')) || '@example.com' AS customer_email,
  split_part(c_name, '#', 1) AS customer_fname,
  c_custkey AS customer_id,
  split_part(c_name, '#', 2) AS customer_lname,
  CAST(NULL AS VARCHAR) AS customer_password,
  CASE c_mktsegment WHEN 'BUILDING' THEN 'Consumer' WHEN 'AUTOMOBILE' THEN 'Corporate'
       WHEN 'MACHINERY' THEN 'Corporate' ELSE 'Home Office' END AS customer_segment,
  CAST(NULL AS VARCHAR) AS customer_state,
  CAST(NULL AS VARCHAR) AS customer_street,
  c_nationkey AS customer_zipcode,
  CAST(NULL AS INTEGER) AS department_id,
  CAST(NULL AS VARCHAR) AS department_name,
  CAST(NULL AS DOUBLE) AS latitude,
  CAST(NULL AS DOUBLE) AS longitude,
  r_name AS market,
  CAST(NULL AS VARCHAR) AS order_city,
  n_name AS order_country,
  o_custkey AS order_customer_id,
  o_orderdate AS order_date_dateorders,
  l_orderkey AS order_id,
  l_partkey AS order_item_cardprod_id,
  CAST(ext * disc AS {MONEY}) AS order_item_discount,
  CAST(disc AS {MONEY}) AS order_item_discount_rate,
  l_linenumber AS order_item_id,
  CAST(p_retailprice AS {MONEY}) AS order_item_product_price,
  CAST(tax AS {MONEY}) AS order_item_profit_ratio,
  CAST(l_quantity AS INTEGER) AS order_item_quantity,
  CAST(ext - ext * disc AS {MONEY}) AS sales,
  CAST(ext - ext * disc AS {MONEY}) AS order_item_total,
  CAST(ext * tax AS {MONEY}) AS order_profit_per_order,
  n_name AS order_region,
  CAST(NULL AS VARCHAR) AS order_state,
  CASE WHEN o_orderstatus = 'P' AND l_returnflag = 'R' THEN 'CANCELED'
       WHEN o_orderstatus = 'P' AND l_returnflag = 'A' AND l_linestatus = 'F' THEN 'SUSPECTED_FRAUD'
       WHEN o_orderstatus = 'P' AND l_returnflag = 'N' AND l_linestatus = 'O' THEN 'PENDING'
       ELSE 'COMPLETE' END AS order_status,
  CAST(NULL AS INTEGER) AS order_zipcode,
  l_partkey AS product_card_id,
  CAST(substr(p_brand, 7, 10) AS INTEGER) AS product_category_id,
  CAST(NULL AS VARCHAR) AS product_description,
  CAST(NULL AS VARCHAR) AS product_image,
  p_name AS product_name,
  CAST(p_retailprice AS {MONEY}) AS product_price,
  CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS product_status,
  l_shipdate AS shipping_date_dateorders,
  CASE prio WHEN 1 THEN 'Same Day' WHEN 2 THEN 'First Class' WHEN 3 THEN 'Second Class'
       ELSE 'Standard Class' END AS shipping_mode,
  l_orderkey, l_linenumber, o_orderdate, l_shipdate
FROM (
  SELECT *, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS prio,
         CAST(date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) AS INTEGER) AS ship_days,
         CAST(l_extendedprice AS DECIMAL(18,2)) AS ext,
         CAST(l_discount AS DECIMAL(18,2)) AS disc,
         CAST(l_tax AS DECIMAL(18,2)) AS tax
  FROM ({LINES}) j
) m
"""

RAW_NAMES = [
    "type", "days_for_shipping_real", "days_for_shipment_scheduled", "benefit_per_order",
    "sales_per_customer", "delivery_status", "late_delivery_risk", "category_id", "category_name",
    "customer_city", "customer_country", "customer_email", "customer_fname", "customer_id",
    "customer_lname", "customer_password", "customer_segment", "customer_state", "customer_street",
    "customer_zipcode", "department_id", "department_name", "latitude", "longitude", "market",
    "order_city", "order_country", "order_customer_id", "order_date_dateorders", "order_id",
    "order_item_cardprod_id", "order_item_discount", "order_item_discount_rate", "order_item_id",
    "order_item_product_price", "order_item_profit_ratio", "order_item_quantity", "sales",
    "order_item_total", "order_profit_per_order", "order_region", "order_state", "order_status",
    "order_zipcode", "product_card_id", "product_category_id", "product_description",
    "product_image", "product_name", "product_price", "product_status",
    "shipping_date_dateorders", "shipping_mode",
]
MOVED = ["order_date_dateorders", "shipping_date_dateorders", "late_delivery_risk", "product_status"]
BRONZE_NAMES = [c for c in RAW_NAMES if c not in MOVED] + MOVED


def _bronze_select(alias: str = "") -> str:
    p = f"{alias}." if alias else ""
    cols = []
    for c in BRONZE_NAMES:
        if c in ("late_delivery_risk", "product_status"):
            cols.append(f"({p}{c} = 1) AS {c}")
        else:
            cols.append(f"{p}{c}")
    return ", ".join(cols)


BRONZE = f"""
SELECT {_bronze_select()}, l_shipdate AS ingested_at FROM ({MODEL}) b
WHERE {" AND ".join(f"({r})" for r in RULES_SQL)}
"""

SILVER_ORDER_MAP = [
    ("order_id", "order_id"), ("order_customer_id", "customer_id"),
    ("order_item_cardprod_id", "product_id"), ("order_item_id", "item_id"),
    ("order_date_dateorders", "order_date"), ("order_item_product_price", "product_price"),
    ("order_item_quantity", "quantity"), ("order_item_total", "line_total"), ("sales", "sales"),
    ("sales_per_customer", "sales_per_customer"), ("order_item_discount", "discount"),
    ("order_item_discount_rate", "discount_rate"), ("order_item_profit_ratio", "profit_ratio"),
    ("order_profit_per_order", "profit_per_order"), ("type", "transaction_method"),
    ("order_status", "order_status"), ("department_id", "store_dept_id"),
    ("department_name", "store_dept_name"), ("customer_city", "store_city"),
    ("customer_state", "store_state"), ("customer_country", "store_country"),
    ("customer_street", "store_street"), ("latitude", "store_latitude"),
    ("longitude", "store_longitude"), ("market", "delivery_market"), ("order_city", "delivery_city"),
    ("order_state", "delivery_state"), ("order_country", "delivery_country"),
    ("order_region", "delivery_region"), ("days_for_shipping_real", "actual_shipping_days"),
    ("days_for_shipment_scheduled", "scheduled_shipping_days"), ("delivery_status", "delivery_status"),
    ("late_delivery_risk", "late_delivery_risk"), ("shipping_mode", "shipping_mode"),
    ("shipping_date_dateorders", "shipping_date"),
]




def scd2_sql(src: str, keys: list[str], seq: str, tracked: list[str], payload: list[str],
             tiebreak: list[str]) -> str:
    """Textbook SCD-2: dedup, lag over the key, running sum of openings."""
    k = ", ".join(keys)
    knn = " AND ".join(f"{c} IS NOT NULL" for c in keys + [seq])
    tb = ", ".join(f"{c} DESC NULLS LAST" for c in tiebreak)
    changed = " OR ".join(f"(lag({c}) OVER w IS DISTINCT FROM {c})" for c in tracked)
    cols = ", ".join(payload)
    return f"""
SELECT {k}, {cols}, __START_AT,
       lead(__START_AT) OVER (PARTITION BY {k} ORDER BY __START_AT) AS __END_AT
FROM (
  SELECT *, min({seq}) OVER (PARTITION BY {k}, _vid) AS __START_AT,
         row_number() OVER (PARTITION BY {k}, _vid ORDER BY {seq} DESC) AS _last
  FROM (
    SELECT *, sum(_open) OVER (PARTITION BY {k} ORDER BY {seq} ROWS UNBOUNDED PRECEDING) AS _vid
    FROM (
      SELECT *, CASE WHEN row_number() OVER w = 1 OR {changed} THEN 1 ELSE 0 END AS _open
      FROM (
        SELECT * FROM (
          SELECT *, row_number() OVER (PARTITION BY {k}, {seq} ORDER BY {tb}) AS _dd
          FROM ({src}) s WHERE {knn}
        ) WHERE _dd = 1
      ) d
      WINDOW w AS (PARTITION BY {k} ORDER BY {seq})
    ) f
  ) g
) v
WHERE _last = 1
"""


CUST_PAYLOAD = ["customer_firstname", "customer_lastname", "customer_segment", "email_masked",
                "password_masked", "customer_zipcode"]
CUST_TRACKED = ["customer_segment", "customer_zipcode"]
PROD_PAYLOAD = ["category_id", "category_name", "product_name", "product_price", "is_notavailable"]
PROD_TRACKED = ["is_notavailable"]


def _tb(tracked, payload):
    return tracked + [c for c in payload if c not in tracked]



SILVER_ORDER_NAMES = [b for _, b in SILVER_ORDER_MAP]


CKEYS = ["customer_id", "customer_firstname", "customer_lastname", "customer_segment", "customer_zipcode"]
_CK = ", ".join(CKEYS)
_CK_ORDER = ", ".join(f"{c} ASC NULLS FIRST" for c in CKEYS)


def _dbl(expr: str) -> str:
    return f"CAST(CAST({expr} AS {MONEY}) AS DOUBLE)"




PKEYS = ["product_id", "product_name", "category_name", "product_price", "is_notavailable"]
_PK = ", ".join(PKEYS)
_PK_ORDER = ", ".join(f"{c} ASC NULLS FIRST" for c in PKEYS)


def _avg(expr: str) -> str:
    return f"CAST(CAST(sum({expr}) AS {MONEY}) AS DOUBLE) / CAST(count({expr}) AS DOUBLE)"





def medallion_sql(BRONZE: str) -> dict:
    """Silver, dimensions and gold SQL over any bronze row source (with ``ingested_at``)."""
    SILVER_ORDERS = f"SELECT {', '.join(f'{a} AS {b}' for a, b in SILVER_ORDER_MAP)} FROM ({BRONZE}) br"
    SILVER_CUSTOMERS = f"""
    SELECT customer_id, customer_fname AS customer_firstname, customer_lname AS customer_lastname,
           customer_segment, sha256(customer_email) AS email_masked,
           CAST(NULL AS VARCHAR) AS password_masked, customer_zipcode, ingested_at AS transformed_at
    FROM ({BRONZE}) br
    """
    SILVER_PRODUCTS = f"""
    SELECT product_card_id AS product_id, category_id, category_name, product_name, product_price,
           product_status AS is_notavailable, ingested_at AS transformed_at
    FROM ({BRONZE}) br
    """
    order = ["order_date_dateorders", "order_id", "order_item_id"]      # changes of one sequence value
    ordered = lambda silver: silver.replace("AS transformed_at", "AS transformed_at, " + ", ".join(order))
    DIM_CUSTOMERS = scd2_sql(ordered(SILVER_CUSTOMERS), ["customer_id"], "transformed_at", CUST_TRACKED,
                             CUST_PAYLOAD, order + _tb(CUST_TRACKED, CUST_PAYLOAD))
    DIM_PRODUCTS = scd2_sql(ordered(SILVER_PRODUCTS), ["product_id"], "transformed_at", PROD_TRACKED,
                            PROD_PAYLOAD, order + _tb(PROD_TRACKED, PROD_PAYLOAD))
    ORDERS_ENRICHED = f"""
    SELECT {", ".join("o." + c for c in SILVER_ORDER_NAMES)},
           c.customer_firstname, c.customer_lastname, c.customer_segment, c.customer_zipcode,
           p.product_name, p.category_id, p.category_name, p.is_notavailable
    FROM ({SILVER_ORDERS}) o
    LEFT JOIN (SELECT * FROM ({DIM_CUSTOMERS}) WHERE __END_AT IS NULL) c ON o.customer_id = c.customer_id
    LEFT JOIN (SELECT * FROM ({DIM_PRODUCTS}) WHERE __END_AT IS NULL) p ON o.product_id = p.product_id
    """
    CUSTOMER_METRICS = f"""
    WITH e AS ({ORDERS_ENRICHED}),
    agg AS (
      SELECT {_CK}, count(order_id) AS total_orders,
             {_dbl('sum(line_total)')} AS total_revenue, {_dbl('sum(profit_per_order)')} AS total_profit,
             max(order_date) AS latest_order_date, min(order_date) AS first_order_date
      FROM e GROUP BY {_CK}),
    allc AS (SELECT DISTINCT {_CK} FROM e),
    ref AS (SELECT CAST(max(order_date) + INTERVAL 1 MONTH AS DATE) AS rd FROM e),
    cm AS (
      SELECT {", ".join("c." + x for x in CKEYS)},
             coalesce(m.total_orders, 0) AS total_orders,
             coalesce(m.total_revenue, 0.0) AS total_revenue,
             coalesce(m.total_profit, 0.0) AS total_profit,
             m.latest_order_date, m.first_order_date
      FROM allc c LEFT JOIN agg m ON c.customer_id = m.customer_id)
    SELECT cm.*,
           CAST(CASE WHEN latest_order_date IS NOT NULL
                     THEN date_diff('day', CAST(latest_order_date AS DATE), rd) ELSE 999999 END AS INTEGER)
             AS days_since_last_order,
           CASE WHEN total_orders > 0 THEN total_revenue / total_orders ELSE 0.0 END AS avg_order_value
    FROM cm, ref
    """
    CUSTOMERS360 = f"""
    WITH q AS (
      SELECT *,
        ntile(5) OVER (ORDER BY days_since_last_order ASC NULLS FIRST, {_CK_ORDER}) AS rq,
        ntile(5) OVER (ORDER BY total_orders DESC NULLS LAST, {_CK_ORDER}) AS fq,
        ntile(5) OVER (ORDER BY total_revenue DESC NULLS LAST, {_CK_ORDER}) AS mq
      FROM ({CUSTOMER_METRICS}) cm),
    s AS (
      SELECT *,
        CAST(CASE WHEN total_orders = 0 THEN 1 ELSE 6 - rq END AS INTEGER) AS recency_score,
        CAST(CASE WHEN total_orders = 0 THEN 1 ELSE 6 - fq END AS INTEGER) AS frequency_score,
        CAST(CASE WHEN total_revenue = 0 THEN 1 ELSE 6 - mq END AS INTEGER) AS monetary_score
      FROM q)
    SELECT {_CK}, total_orders, total_revenue, total_profit, avg_order_value,
           latest_order_date, first_order_date, days_since_last_order,
           recency_score, frequency_score, monetary_score,
           CAST(recency_score AS VARCHAR) || CAST(frequency_score AS VARCHAR) || CAST(monetary_score AS VARCHAR)
             AS rfm_score,
           CASE
             WHEN recency_score >= 4 AND frequency_score >= 4 AND monetary_score >= 4 THEN 'Champions'
             WHEN recency_score >= 3 AND frequency_score >= 3 AND monetary_score >= 3 THEN 'Loyal Customers'
             WHEN recency_score >= 4 AND frequency_score BETWEEN 2 AND 3 THEN 'Potential Loyalists'
             WHEN recency_score >= 4 AND frequency_score <= 1 THEN 'New Customers'
             WHEN recency_score <= 2 AND frequency_score >= 3 AND monetary_score >= 3 THEN 'At Risk'
             WHEN recency_score <= 2 AND frequency_score >= 4 AND monetary_score >= 4 THEN 'Cannot Lose Them'
             WHEN recency_score <= 2 AND frequency_score >= 2 THEN 'Hibernating'
             WHEN recency_score <= 1 AND total_orders > 0 THEN 'Lost Customers'
             WHEN total_orders = 0 THEN 'Prospects'
             ELSE 'Other' END AS rfm_segment
    FROM s
    """
    PRODUCT_METRICS = f"""
    SELECT {_PK},
      count(order_id) AS total_orders,
      CAST(sum(quantity) AS BIGINT) AS units_sold,
      {_dbl('sum(line_total)')} AS total_revenue,
      {_dbl('sum(profit_per_order)')} AS total_profit,
      {_avg('line_total')} AS avg_order_value,
      {_avg('profit_per_order')} AS avg_profit_per_order,
      {_avg('discount_rate')} AS avg_discount_rate,
      {_avg('profit_ratio')} AS avg_profit_ratio,
      {_avg('product_price')} AS avg_price_charged,
      count(DISTINCT customer_id) AS unique_customers,
      min(order_date) AS first_order_date,
      max(order_date) AS last_order_date,
      count(CASE WHEN customer_segment = 'Consumer' THEN 1 END) AS consumer_orders,
      count(CASE WHEN customer_segment = 'Corporate' THEN 1 END) AS corporate_orders,
      count(CASE WHEN customer_segment = 'Home Office' THEN 1 END) AS home_office_orders,
      count(CASE WHEN order_status = 'COMPLETE' THEN 1 END) AS completed_orders,
      count(CASE WHEN order_status IN ('CANCELED', 'CLOSED') THEN 1 END) AS canceled_orders,
      count(CASE WHEN order_status = 'SUSPECTED_FRAUD' THEN 1 END) AS fraud_orders,
      count(CASE WHEN order_status IN ('PENDING', 'PROCESSING', 'ON_HOLD', 'PAYMENT_REVIEW') THEN 1 END)
        AS pending_orders,
      {_avg("date_diff('day', CAST(order_date AS DATE), CAST(shipping_date AS DATE))")} AS avg_order_cycle_days,
      {_avg('actual_shipping_days')} AS avg_shipping_days,
      CAST(sum(CASE WHEN late_delivery_risk = true THEN 1 ELSE 0 END) AS BIGINT) AS late_deliveries
    FROM ({ORDERS_ENRICHED}) e
    GROUP BY {_PK}
    """
    PRODUCT_RATES = f"""
    SELECT *,
      CASE WHEN total_orders > 0 THEN completed_orders / total_orders ELSE 0 END AS order_completion_rate,
      CASE WHEN total_orders > 0 THEN canceled_orders / total_orders ELSE 0 END AS order_cancellation_rate,
      CASE WHEN total_orders > 0 THEN fraud_orders / total_orders ELSE 0 END AS order_fraud_rate,
      CASE WHEN total_orders > 0 THEN pending_orders / total_orders ELSE 0 END AS order_pending_rate,
      CAST(date_diff('day', CAST(first_order_date AS DATE), CAST(last_order_date AS DATE)) AS INTEGER)
        AS days_in_catalog
    FROM ({PRODUCT_METRICS}) pm
    """
    PRODUCTS360 = f"""
    WITH q AS (
      SELECT *,
        CAST(ntile(5) OVER (ORDER BY total_revenue DESC NULLS LAST, {_PK_ORDER}) AS INTEGER) AS revenue_quintile,
        CAST(ntile(4) OVER (ORDER BY avg_profit_per_order DESC NULLS LAST, {_PK_ORDER}) AS INTEGER)
          AS margin_quartile
      FROM ({PRODUCT_RATES}) r),
    s AS (
      SELECT *,
        CAST(CASE WHEN total_orders = 0 THEN 1 ELSE 6 - revenue_quintile END AS INTEGER) AS revenue_score,
        CAST(CASE WHEN total_orders = 0 THEN 1 ELSE 5 - margin_quartile END AS INTEGER) AS margin_score
      FROM q),
    t AS (
      SELECT *,
        CASE WHEN revenue_score >= 4 THEN 'Star Products' WHEN revenue_score >= 3 THEN 'Strong Performers'
             WHEN revenue_score >= 2 THEN 'Steady Performers' WHEN revenue_score >= 1 THEN 'Weak Performers'
             ELSE 'Slow Movers' END AS performance_tier,
        CASE WHEN margin_score >= 3 THEN 'High Margin' WHEN margin_score >= 2 THEN 'Medium Margin'
             WHEN margin_score >= 1 THEN 'Low Margin' ELSE 'Very Low Margin' END AS margin_category
      FROM s)
    SELECT *,
      CASE WHEN performance_tier IN ('Star Products', 'Strong Performers') AND order_completion_rate >= 0.9
                AND order_cancellation_rate < 0.05 THEN 'Healthy'
           WHEN order_cancellation_rate > 0.10 OR order_fraud_rate > 0.05 OR order_completion_rate < 0.8
                THEN 'At Risk'
           ELSE 'Monitor' END AS product_health,
      CASE WHEN performance_tier = 'Star Products' AND margin_category = 'High Margin' THEN 'Invest & Promote'
           WHEN order_cancellation_rate > 0.15 OR order_fraud_rate > 0.10 THEN 'Investigate Quality Issues'
           WHEN performance_tier = 'Slow Movers' AND order_cancellation_rate > 0.10 THEN 'Consider Discontinuing'
           ELSE 'Maintain' END AS strategic_priority
    FROM t
    """
    return {
        "SILVER_ORDERS": SILVER_ORDERS,
        "SILVER_CUSTOMERS": SILVER_CUSTOMERS,
        "SILVER_PRODUCTS": SILVER_PRODUCTS,
        "DIM_CUSTOMERS": DIM_CUSTOMERS,
        "DIM_PRODUCTS": DIM_PRODUCTS,
        "ORDERS_ENRICHED": ORDERS_ENRICHED,
        "CUSTOMER_METRICS": CUSTOMER_METRICS,
        "CUSTOMERS360": CUSTOMERS360,
        "PRODUCT_METRICS": PRODUCT_METRICS,
        "PRODUCT_RATES": PRODUCT_RATES,
        "PRODUCTS360": PRODUCTS360,
    }


_M = medallion_sql(BRONZE)
SILVER_ORDERS = _M["SILVER_ORDERS"]
SILVER_CUSTOMERS = _M["SILVER_CUSTOMERS"]
SILVER_PRODUCTS = _M["SILVER_PRODUCTS"]
DIM_CUSTOMERS = _M["DIM_CUSTOMERS"]
DIM_PRODUCTS = _M["DIM_PRODUCTS"]
ORDERS_ENRICHED = _M["ORDERS_ENRICHED"]
CUSTOMER_METRICS = _M["CUSTOMER_METRICS"]
CUSTOMERS360 = _M["CUSTOMERS360"]
PRODUCT_METRICS = _M["PRODUCT_METRICS"]
PRODUCT_RATES = _M["PRODUCT_RATES"]
PRODUCTS360 = _M["PRODUCTS360"]

EVENTS_CHANGES = "SELECT user_id, ts, event_type, value FROM events"
SCD2_EVENTS = scd2_sql(EVENTS_CHANGES, ["user_id"], "ts", ["event_type"], ["event_type", "value"],
                       ["event_type", "value"])

QUERIES = {
    "orders_enriched": ORDERS_ENRICHED,
    "customer_metrics": CUSTOMER_METRICS,
    "customers360": CUSTOMERS360,
    "product_metrics": PRODUCT_METRICS,
    "product_rates": PRODUCT_RATES,
    "products360": PRODUCTS360,
    "reference_date": f"SELECT CAST(max(order_date) + INTERVAL 1 MONTH AS DATE) AS reference_date "
                      f"FROM ({ORDERS_ENRICHED}) e",
    "silver_orders": SILVER_ORDERS,
    "silver_customers": SILVER_CUSTOMERS,
    "silver_products": SILVER_PRODUCTS,
    "scd2_batch": SCD2_EVENTS,
    "scd2_batch_products": DIM_PRODUCTS,
    "scd2_customers": DIM_CUSTOMERS,
    "scd2_current": f"SELECT * FROM ({SCD2_EVENTS}) h WHERE __END_AT IS NULL",
    "scd2_closed": f"SELECT * FROM ({SCD2_EVENTS}) h WHERE __END_AT IS NOT NULL",
}

# ---------------------------------------------------------------------------
# Landing CSV path: the same lines as text, with the injected defects.

RAW_HEADERS = [
    "Type", "Days for shipping (real)", "Days for shipment (scheduled)", "Benefit per order",
    "Sales per customer", "Delivery Status", "Late_delivery_risk", "Category Id", "Category Name",
    "Customer City", "Customer Country", "Customer Email", "Customer Fname", "Customer Id",
    "Customer Lname", "Customer Password", "Customer Segment", "Customer State", "Customer Street",
    "Customer Zipcode", "Department Id", "Department Name", "Latitude", "Longitude", "Market",
    "Order City", "Order Country", "Order Customer Id", "order date (DateOrders)", "Order Id",
    "Order Item Cardprod Id", "Order Item Discount", "Order Item Discount Rate", "Order Item Id",
    "Order Item Product Price", "Order Item Profit Ratio", "Order Item Quantity", "Sales",
    "Order Item Total", "Order Profit Per Order", "Order Region", "Order State", "Order Status",
    "Order Zipcode", "Product Card Id", "Product Category Id", "Product Description",
    "Product Image", "Product Name", "Product Price", "Product Status",
    "shipping date (DateOrders)", "Shipping Mode",
]

DEFECT = ("CASE (l_orderkey + l_linenumber) % 97 WHEN 0 THEN 'zero_quantity' "
          "WHEN 1 THEN 'bad_order_date' WHEN 2 THEN 'missing_status' WHEN 3 THEN 'zero_price' "
          "WHEN 4 THEN 'text_in_int' WHEN 5 THEN 'bad_ship_date' WHEN 6 THEN 'text_in_category' END")
_MALFORMED = "coalesce(_defect IN ('text_in_int', 'text_in_category'), false) AS malformed"

DEFECTED = f"SELECT *, {DEFECT} AS _defect FROM ({MODEL}) mm"

_CLEAN_OVERRIDES = {
    "order_item_quantity": "CASE WHEN _defect = 'zero_quantity' THEN 0 ELSE order_item_quantity END",
    "order_date_dateorders": "CASE WHEN _defect = 'bad_order_date' THEN NULL ELSE order_date_dateorders END",
    "order_status": "CASE WHEN _defect = 'missing_status' THEN NULL ELSE order_status END",
    "order_item_product_price": (f"CASE WHEN _defect = 'zero_price' THEN CAST(0 AS {MONEY}) "
                                 "ELSE order_item_product_price END"),
    "order_id": "CASE WHEN _defect = 'text_in_int' THEN NULL ELSE order_id END",
    "shipping_date_dateorders": "CASE WHEN _defect = 'bad_ship_date' THEN NULL ELSE shipping_date_dateorders END",
    "category_id": "CASE WHEN _defect = 'text_in_category' THEN NULL ELSE category_id END",
    "late_delivery_risk": "(late_delivery_risk = 1)",
    "product_status": "(product_status = 1)",
}


def _clean_select(overrides=None) -> str:
    ov = dict(_CLEAN_OVERRIDES)
    ov.update(overrides or {})
    return ", ".join(f"{ov.get(c, c)} AS {c}" for c in BRONZE_NAMES)


CLEAN_LINES = (f"SELECT {_clean_select()}, {_MALFORMED} "
               f"FROM ({DEFECTED}) dd")
CLEAN_LINES_LATIN1 = (f"SELECT {_clean_select({'customer_fname': "customer_fname || 'é'"})}, "
                      f"{_MALFORMED} FROM ({DEFECTED}) dd")

_ALL_RULES = " AND ".join(f"coalesce({r}, false)" for r in RULES_SQL)
BRONZE_FROM_LANDING = (f"SELECT {', '.join(BRONZE_NAMES)} FROM ({CLEAN_LINES}) cl "
                       f"WHERE NOT malformed AND {_ALL_RULES}")
_FAILED = ", ".join(["CASE WHEN malformed THEN 'malformed' END"]
                    + [f"CASE WHEN NOT coalesce({r}, false) THEN '{n}' END"
                       for r, n in zip(RULES_SQL, RULE_NAMES)])
QUARANTINE = (f"SELECT {', '.join(BRONZE_NAMES)}, concat_ws(',', {_FAILED}) AS failed_rules "
              f"FROM ({CLEAN_LINES}) cl WHERE malformed OR NOT ({_ALL_RULES})")
RULE_METRICS = ("SELECT count(*) AS input_rows, count_if(malformed) AS malformed, "
                + ", ".join(f"count_if(NOT coalesce({r}, false)) AS {n}" for r, n in zip(RULES_SQL, RULE_NAMES))
                + f" FROM ({CLEAN_LINES}) cl")

_DATE_TEXT = ("CASE l_orderkey % 3 WHEN 0 THEN strftime({c}, '%-m/%-d/%Y %-H:%M') "
              "WHEN 1 THEN strftime({c}, '%m/%d/%Y %H:%M') ELSE strftime({c}, '%d-%m-%Y %H:%M') END")
_TEXT_OVERRIDES = {
    "order_item_quantity": "CASE WHEN _defect = 'zero_quantity' THEN '0' ELSE CAST(order_item_quantity AS VARCHAR) END",
    "order_date_dateorders": ("CASE WHEN _defect = 'bad_order_date' THEN strftime(o_orderdate, '%Y-%m-%d') ELSE "
                              + _DATE_TEXT.format(c="o_orderdate") + " END"),
    "order_status": "CASE WHEN _defect = 'missing_status' THEN NULL ELSE order_status END",
    "order_item_product_price": ("CASE WHEN _defect = 'zero_price' THEN '0.0000' "
                                 "ELSE CAST(order_item_product_price AS VARCHAR) END"),
    "order_id": "CASE WHEN _defect = 'text_in_int' THEN 'X' || CAST(order_id AS VARCHAR) ELSE CAST(order_id AS VARCHAR) END",
    "category_id": "CASE WHEN _defect = 'text_in_category' THEN 'n/a' ELSE CAST(category_id AS VARCHAR) END",
    "shipping_date_dateorders": ("CASE WHEN _defect = 'bad_ship_date' THEN 'not a date' ELSE "
                                 + _DATE_TEXT.format(c="l_shipdate") + " END"),
}


def _text_select(names: list[str]) -> str:
    return ", ".join(f"{_TEXT_OVERRIDES.get(c, f'CAST({c} AS VARCHAR)')} AS \"{n}\""
                     for c, n in zip(RAW_NAMES, names))


UNTYPED_LINES = f"SELECT {_text_select(RAW_HEADERS)} FROM ({DEFECTED}) dd"
NORMALIZED_LINES = f"SELECT {_text_select(RAW_NAMES)} FROM ({DEFECTED}) dd"

PARSE_MULTI_TS = f"""
SELECT order_id AS order_id_text, order_item_id AS order_item_id_text,
       order_date_dateorders AS order_date_text,
       CASE WHEN _defect = 'bad_order_date' THEN NULL ELSE o_orderdate END AS order_date,
       shipping_date_dateorders AS shipping_date_text,
       CASE WHEN _defect = 'bad_ship_date' THEN NULL ELSE l_shipdate END AS shipping_date
FROM (SELECT {_text_select(RAW_NAMES)}, _defect, o_orderdate, l_shipdate FROM ({DEFECTED}) dd) t
"""

QUERIES.update({
    "csv_batch_untyped": UNTYPED_LINES,
    "normalize_columns": NORMALIZED_LINES,
    "parse_multi_ts": PARSE_MULTI_TS,
    "clean_lines": CLEAN_LINES,
    "csv_batch_latin1": CLEAN_LINES_LATIN1,
    "expect_or_drop": BRONZE_FROM_LANDING,
    "quarantine_malformed": QUARANTINE,
    "expectation_metrics": RULE_METRICS,
})

# ---------------------------------------------------------------------------
# Streaming and full-pipeline paths over the landing files.

_LANDING_BRONZE = f"SELECT *, shipping_date_dateorders AS ingested_at FROM ({BRONZE_FROM_LANDING}) lb"
_PIPE = medallion_sql(_LANDING_BRONZE)

QUERIES.update({
    "bronze_compacted": BRONZE_FROM_LANDING,
    "stream_csv_to_bronze": BRONZE_FROM_LANDING,
    "stream_silver_orders": _PIPE["SILVER_ORDERS"],
    "scd2_stream": SCD2_EVENTS,
    "pipeline_orders_enriched": _PIPE["ORDERS_ENRICHED"],
    "pipeline_customers360": _PIPE["CUSTOMERS360"],
    "pipeline_products360": _PIPE["PRODUCTS360"],
})

# ---------------------------------------------------------------------------
# Change load (5 customers), lookups, history after the change load, misc.

CHANGE_K = 5
CHANGE_SEED = 42
CHANGE_SEQ = "TIMESTAMP '2099-12-31 00:00:00'"

CHOSEN = f"""
SELECT customer_id FROM (SELECT DISTINCT customer_id FROM ({BRONZE}) b WHERE customer_id IS NOT NULL) d
ORDER BY ((customer_id + {CHANGE_SEED}) % 4294967291) * 40503 % 4294967291, customer_id
LIMIT {CHANGE_K}
"""
ROWS_OF_CHANGED = f"SELECT * FROM ({BRONZE}) b WHERE customer_id IN ({CHOSEN})"
_CHANGE_OVERRIDES = {
    "product_status": "NOT product_status",
    "customer_segment": ("CASE customer_segment WHEN 'Consumer' THEN 'Corporate' WHEN 'Corporate' "
                         "THEN 'Home Office' ELSE 'Consumer' END"),
    "customer_zipcode": "CAST(customer_zipcode + 1 AS INTEGER)",
}
CHANGE_LOAD = (f"SELECT {', '.join(f'{_CHANGE_OVERRIDES.get(c, c)} AS {c}' for c in BRONZE_NAMES + ['ingested_at'])} "
               f"FROM ({ROWS_OF_CHANGED}) r")
_CHANGE_AT = (f"SELECT {', '.join(BRONZE_NAMES)}, {CHANGE_SEQ} AS ingested_at FROM ({CHANGE_LOAD}) c")
_WITH_CHANGES = medallion_sql(f"SELECT * FROM ({BRONZE}) b UNION ALL SELECT * FROM ({_CHANGE_AT}) c")

DISTINCT_COUNTS = f"""
SELECT (SELECT count(DISTINCT customer_id) FROM ({BRONZE}) b) AS base_customers,
       (SELECT count(DISTINCT customer_id) FROM ({CHANGE_LOAD}) c) AS changed_customers,
       (SELECT count(*) FROM ({ROWS_OF_CHANGED}) r) AS base_rows_of_changed
"""

_MOST_VERSIONS = f"""
SELECT product_id FROM ({DIM_PRODUCTS}) h GROUP BY product_id ORDER BY count(*) DESC, product_id LIMIT 1
"""

QUERIES.update({
    "customers360_range": CUSTOMERS360,
    "products360_range": PRODUCTS360,
    "synth_changes": CHANGE_LOAD,
    "rows_of_changed_keys": ROWS_OF_CHANGED,
    "distinct_customer_count": DISTINCT_COUNTS,
    "scd2_after_changes": _WITH_CHANGES["DIM_CUSTOMERS"],
    "customers360_after_changes": _WITH_CHANGES["CUSTOMERS360"],
    "distinct_customers": (f"SELECT DISTINCT customer_id, customer_firstname, customer_lastname, "
                           f"customer_segment, customer_zipcode FROM ({ORDERS_ENRICHED}) e"),
    "miles_to_km": "SELECT event_id, value, CAST(value * 1.60934 AS FLOAT) AS value_km FROM events",
    "sql_current_dim": f"SELECT * FROM ({DIM_PRODUCTS}) h WHERE __END_AT IS NULL",
    "scd2_key_history": f"SELECT * FROM ({DIM_PRODUCTS}) h WHERE product_id = 1",
    "scd2_stored_key_history": f"SELECT * FROM ({DIM_PRODUCTS}) h WHERE product_id = 1",
    "audit_stamps": f"SELECT count(*) AS n_rows, count(*) AS n_stamped, CAST(1 AS BIGINT) AS n_stamps FROM ({_PIPE['SILVER_ORDERS']}) o",
    "scd2_busiest_key_history": f"SELECT * FROM ({DIM_PRODUCTS}) h WHERE product_id = ({_MOST_VERSIONS})",
})

# ---------------------------------------------------------------------------
# Intermediate steps of the gold views, as their own checks.

CUSTOMER_QUINTILES = f"""
SELECT *,
  CAST(ntile(5) OVER (ORDER BY days_since_last_order ASC NULLS FIRST, {_CK_ORDER}) AS INTEGER) AS recency_quintile,
  CAST(ntile(5) OVER (ORDER BY total_orders DESC NULLS LAST, {_CK_ORDER}) AS INTEGER) AS frequency_quintile,
  CAST(ntile(5) OVER (ORDER BY total_revenue DESC NULLS LAST, {_CK_ORDER}) AS INTEGER) AS monetary_quintile
FROM ({CUSTOMER_METRICS}) cm
"""
RFM_SCORES = f"""
SELECT *, CAST(recency_score AS VARCHAR) || CAST(frequency_score AS VARCHAR) || CAST(monetary_score AS VARCHAR)
            AS rfm_score
FROM (SELECT *,
        CAST(CASE WHEN total_orders = 0 THEN 1 ELSE 6 - recency_quintile END AS INTEGER) AS recency_score,
        CAST(CASE WHEN total_orders = 0 THEN 1 ELSE 6 - frequency_quintile END AS INTEGER) AS frequency_score,
        CAST(CASE WHEN total_revenue = 0 THEN 1 ELSE 6 - monetary_quintile END AS INTEGER) AS monetary_score
      FROM ({CUSTOMER_QUINTILES}) q) s
"""
PRODUCT_QUANTILES = f"""
SELECT *,
  CAST(ntile(5) OVER (ORDER BY total_revenue DESC NULLS LAST, {_PK_ORDER}) AS INTEGER) AS revenue_quintile,
  CAST(ntile(4) OVER (ORDER BY avg_profit_per_order DESC NULLS LAST, {_PK_ORDER}) AS INTEGER) AS margin_quartile
FROM ({PRODUCT_RATES}) r
"""
INT_TO_BOOL = f"""
SELECT order_id AS order_id_text, late_delivery_risk AS late_delivery_risk_text,
       product_status AS product_status_text,
       CASE late_delivery_risk WHEN '1' THEN true WHEN '0' THEN false END AS late_delivery_risk,
       CASE product_status WHEN '1' THEN true WHEN '0' THEN false END AS product_status
FROM ({NORMALIZED_LINES}) t
"""

QUERIES.update({
    "customer_quintiles": CUSTOMER_QUINTILES,
    "rfm_scores": RFM_SCORES,
    "product_quantiles": PRODUCT_QUANTILES,
    "int_to_bool": INT_TO_BOOL,
})
