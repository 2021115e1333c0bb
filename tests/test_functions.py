import datetime as dt

from pyspark.sql import functions as F

from tidewater.functions.expressions import int_to_bool, miles_to_km, parse_multi_ts
from tidewater.operators.clean import clean, normalize_columns
from tidewater.schemas import normalize_name


def test_normalize_name():
    assert normalize_name("order date (DateOrders)") == "order_date_dateorders"
    assert normalize_name("[A] {b} ") == "a_b"
    assert normalize_name("Customer Id") == "customer_id"


def test_normalize_columns_idempotent(spark):
    df = spark.createDataFrame([(1, 2)], ["Order Id", "shipping date (DateOrders)"])
    once = normalize_columns(df)
    assert once.columns == ["order_id", "shipping_date_dateorders"]
    assert normalize_columns(once).columns == once.columns


def test_parse_multi_ts(spark):
    cases = [
        ("1/5/2018 9:05", dt.datetime(2018, 1, 5, 9, 5)),
        ("01/05/2018 09:05", dt.datetime(2018, 1, 5, 9, 5)),
        ("13-01-2018 12:27", dt.datetime(2018, 1, 13, 12, 27)),
        ("1-2-2018 3:04", None),
        ("garbage", None),
        ("2018-01-01", None),
        (None, None),
    ]
    df = spark.createDataFrame([(c,) for c, _ in cases], "s string")
    got = [r[0] for r in df.select(parse_multi_ts("s")).collect()]
    assert got == [e for _, e in cases]


def test_parse_multi_ts_ignores_session_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        df = spark.createDataFrame([("3/11/2018 2:30",), ("11-03-2018 02:30",)], "s string")
        got = [r[0] for r in df.select(parse_multi_ts("s")).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert got == [dt.datetime(2018, 3, 11, 2, 30)] * 2       # inside the DST gap there


def test_int_to_bool(spark):
    df = spark.createDataFrame([(1,), (0,), (2,), (None,)], "x int")
    assert [r[0] for r in df.select(int_to_bool("x")).collect()] == [True, False, None, None]


def test_miles_to_km_null_safe(spark):
    df = spark.createDataFrame([(1.0,), (None,), (10.0,)], "m double")
    got = [r[0] for r in df.select(miles_to_km("m")).collect()]
    assert got[1] is None
    assert abs(got[0] - 1.60934) < 1e-6 and abs(got[2] - 16.0934) < 1e-4


def test_clean_moves_columns_to_end(spark):
    df = spark.createDataFrame(
        [("a", "1/5/2018 9:05", 1, "x", "13-01-2018 12:27", 0)],
        "`Type` string, `order date (DateOrders)` string, `Late_delivery_risk` int, `Z` string, "
        "`shipping date (DateOrders)` string, `Product Status` int")
    out = clean(df)
    assert out.columns == ["type", "z", "order_date_dateorders", "shipping_date_dateorders",
                           "late_delivery_risk", "product_status"]
    r = out.collect()[0]
    assert r.order_date_dateorders == dt.datetime(2018, 1, 5, 9, 5)
    assert r.late_delivery_risk is True and r.product_status is False
    assert dict(out.dtypes)["order_date_dateorders"] == "timestamp_ntz"
