from tidewater.operators.rules import RULES, expect_or_drop, quarantine, rule_failure_counts
from tidewater.plans import ingest as I
from tidewater.schemas import RAW_HEADERS
from tidewater.sources.landing import read_landing


def _valid_row(**over):
    row = {c: "x" for c in ["type", "order_status", "shipping_mode", "delivery_status", "market",
                            "order_region"]}
    row.update(customer_id=1, order_id=1, order_item_cardprod_id=1, product_card_id=1,
               order_date_dateorders="2018-01-01", order_item_quantity=1, order_item_product_price=1.0)
    row.update(over)
    return row


def _df(spark, rows):
    schema = ("type string, order_status string, shipping_mode string, delivery_status string, "
              "market string, order_region string, customer_id long, order_id long, "
              "order_item_cardprod_id long, product_card_id long, order_date_dateorders string, "
              "order_item_quantity int, order_item_product_price double")
    cols = [f.split()[0] for f in schema.split(", ")]
    return spark.createDataFrame([tuple(r[c] for c in cols) for r in rows], schema)


def test_quantity_and_price_boundaries(spark):
    rows = [_valid_row(order_item_quantity=q) for q in (0, -1, None, 1)]
    rows += [_valid_row(order_item_product_price=p) for p in (0.0, 0.01)]
    kept = expect_or_drop(_df(spark, rows)).collect()
    assert sorted((r.order_item_quantity, r.order_item_product_price) for r in kept) == [(1, 0.01), (1, 1.0)]


def test_each_not_null_rule_drops(spark):
    nullable = ["type", "customer_id", "order_id", "order_item_cardprod_id", "order_date_dateorders",
                "product_card_id", "order_status", "shipping_mode", "delivery_status", "market",
                "order_region"]
    rows = [_valid_row(**{c: None}) for c in nullable]
    df = _df(spark, rows)
    assert expect_or_drop(df).count() == 0
    q = quarantine(df).collect()
    assert len(q) == len(nullable)
    assert all(len(r.failed_rules) == 1 for r in q)
    counts = rule_failure_counts(df).collect()[0].asDict()
    assert counts["input_rows"] == len(nullable)
    assert sum(counts[r] for r in RULES) == len(nullable)


def test_malformed_csv_lines_are_quarantined(spark, tmp_dir):
    path = tmp_dir("malformed")
    import os
    os.makedirs(path, exist_ok=True)
    good = ["DEBIT"] + ["1"] * 52
    header = ",".join(f'"{h}"' for h in RAW_HEADERS)
    lines = [header,
             ",".join(good),                         # fits the schema (rules may still fail)
             ",".join(good[:10]),                    # too few fields
             ",".join(good + ["extra"]),             # too many fields
             ",".join(good[:29] + ["X1"] + good[30:])]  # text in the order id column
    with open(os.path.join(path, "part-0.csv"), "w") as f:
        f.write("\n".join(lines) + "\n")
    df = read_landing(spark, path)
    flags = [r["_rescued_record"] is not None for r in df.collect()]
    assert flags == [False, True, True, True]
    q = I.quarantine_batch(spark, path).collect()
    assert sum("malformed" in r.failed_rules for r in q) == 3
