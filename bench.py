"""Benchmark the headline queries; prints ONE JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_REPEAT (timed runs after one warm-up, default 3; the median is kept).

Stages follow the pipeline: bronze and the two history dimensions are
stored tables, gold queries read them.  Each query is forced to completion
with the ``noop`` sink (full computation, nothing collected to the driver).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from tidewater.operators.ranking import asc, desc, ntile_columns  # noqa: E402
from tidewater.operators.scd2 import current, scd2  # noqa: E402
from tidewater.plans import ingest as I  # noqa: E402
from tidewater.plans.customers import customers360  # noqa: E402
from tidewater.plans.enrich import orders_enriched  # noqa: E402
from tidewater.plans.model import Medallion  # noqa: E402
from tidewater.plans.products import products360  # noqa: E402
from tidewater.schemas import CUSTOMER_DIM_KEYS, CUSTOMER_TRACKED, PRODUCT_DIM_KEYS, PRODUCT_TRACKED  # noqa: E402
from tidewater.session import build_session, scratch_path, table_path  # noqa: E402
from tidewater.sinks.tables import materialize  # noqa: E402
from tidewater.streaming import bronze as SB  # noqa: E402
from tidewater.streaming.scd2_refresh import read_dimension, start_scd2_stream  # noqa: E402
from tidewater.operators import silver as S  # noqa: E402


def noop(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(fn, repeat: int) -> float:
    fn()                                   # warm-up
    runs = []
    for _ in range(repeat):
        t0 = time.perf_counter()
        fn()
        runs.append(time.perf_counter() - t0)
    return statistics.median(runs)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    spark = build_session(f"local[{cpus}]", max(8, 2 * cpus), app_name="tidewater-bench",
                          extra={"spark.driver.memory": "8g"})
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    q: dict[str, float] = {}
    info: dict[str, object] = {}

    m = Medallion(spark, sf_dir)
    t0 = time.perf_counter()
    bronze = m.bronze                         # written once, as the pipeline stores it
    q["bronze_from_tables"] = time.perf_counter() - t0
    n_lines = bronze.count()
    info["lines"] = n_lines

    t0 = time.perf_counter()
    dim_c = materialize(spark, scd2(S.silver_customers(bronze), CUSTOMER_DIM_KEYS, S.SEQ, CUSTOMER_TRACKED), "dim_c")
    dim_p = materialize(spark, scd2(S.silver_products(bronze), PRODUCT_DIM_KEYS, S.SEQ, PRODUCT_TRACKED), "dim_p")
    q["scd2_dimensions"] = time.perf_counter() - t0

    def enriched():
        return orders_enriched(S.silver_orders(bronze), current(dim_c), current(dim_p))

    q["orders_enriched"] = timed(lambda: noop(enriched()), repeat)
    stored = materialize(spark, enriched(), "orders_enriched")
    q["customers360"] = timed(lambda: noop(customers360(stored)), repeat)
    q["products360"] = timed(lambda: noop(products360(stored)), repeat)

    ev = spark.read.parquet(table_path(sf_dir, "events")).select("user_id", "ts", "event_type", "value")
    q["scd2_batch"] = timed(lambda: noop(scd2(ev, ["user_id"], "ts", ["event_type"])), repeat)

    src = scratch_path(spark, "bench-events")
    ev.repartitionByRange(10, "ts").write.parquet(src)

    def scd2_stream():
        changes = spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1).parquet(src)
        dim = scratch_path(spark, "bench-dim")
        start_scd2_stream(changes, scratch_path(spark, "bench-log"), dim, scratch_path(spark, "bench-cp"),
                          ["user_id"], "ts", ["event_type"], key_buckets=16).awaitTermination()
        noop(read_dimension(spark, dim))
    q["scd2_stream"] = timed(scd2_stream, max(1, repeat // 2))

    landing = I.write_landing(spark, sf_dir)

    def stream_bronze():
        SB.start_bronze(spark, landing, scratch_path(spark, "bench-bronze"),
                        scratch_path(spark, "bench-cp")).awaitTermination()
    q["stream_csv_to_bronze"] = timed(stream_bronze, max(1, repeat // 2))
    info["stream_csv_to_bronze_rows_per_sec"] = round(n_lines / q["stream_csv_to_bronze"])

    li = spark.read.parquet(table_path(sf_dir, "lineitem")).select("l_orderkey", "l_linenumber", "l_extendedprice")
    order = [desc("l_extendedprice"), asc("l_orderkey"), asc("l_linenumber")]
    base = li.checkpoint(eager=True)
    q["ntile_builtin"] = timed(lambda: noop(ntile_columns(base, [("q", 5, order)], method="builtin")), repeat)
    q["ntile_range"] = timed(lambda: noop(ntile_columns(base, [("q", 5, order)], method="range",
                                                          ranges=2 * cpus)), repeat)

    total = sum(v for k, v in q.items())
    print(json.dumps({"metric": "total_query_sec", "value": round(total, 3), "unit": "sec",
                      "queries": {k: round(v, 3) for k, v in q.items()}, "sf": sf,
                      "cpus": cpus, "repeat": repeat, "info": info}))
    spark.stop()


if __name__ == "__main__":
    main()
