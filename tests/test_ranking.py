import pytest
from pyspark.sql import functions as F

from tidewater.operators import ranking
from tidewater.operators.ranking import SortKey, asc, builtin_ntile, cut_ntiles, desc, ntile_columns, range_ntile


@pytest.mark.parametrize("n,k,ties", [(1, 5, 1), (3, 5, 1), (5, 4, 1), (1237, 5, 1), (1237, 4, 7), (1500, 5, 86)])
def test_range_ntile_equals_builtin(spark, n, k, ties):
    df = spark.range(n).select(F.col("id"), (F.col("id") % ties).alias("v"),
                               F.when(F.col("id") % 11 == 0, None).otherwise(F.col("id") % 13).alias("w"))
    order = [desc("v"), asc("w"), asc("id")]
    want = {r.id: r.q for r in builtin_ntile(df, k, order, "q").collect()}
    got = {r.id: r.q for r in range_ntile(df, k, order, "q", ranges=13).collect()}
    assert got == want


def test_ntile_columns_range_chain(spark):
    df = spark.range(500).select("id", (F.col("id") * 7 % 31).alias("a"), (F.col("id") % 5).alias("b"))
    specs = [("qa", 5, [asc("a"), asc("id")]), ("qb", 4, [desc("b"), asc("id")])]
    want = sorted(tuple(r) for r in ntile_columns(df, specs, method="builtin").collect())
    got = sorted(tuple(r) for r in ntile_columns(df, specs, method="range", ranges=9).collect())
    assert got == want


def test_range_reads_its_input_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    df = spark.range(300).mapInArrow(count, "id long")
    specs = [("qa", 5, [asc("id")]), ("qb", 4, [desc("id")])]
    got = sorted(tuple(r) for r in ntile_columns(df, specs, method="range").collect())
    assert seen.value == 300
    assert got == [(i, i // 60 + 1, (299 - i) // 75 + 1) for i in range(300)]


def test_one_value_holding_a_third_of_rows_is_split(spark):
    n = 3000
    df = spark.range(n).select("id", F.when(F.col("id") < 1000, 0).otherwise(F.col("id")).alias("v"))
    order = [asc("v"), asc("id")]
    placed = df.repartitionByRange(10, *[o.expr() for o in order])
    sizes = [r[1] for r in placed.groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) < 1000    # the hot value spans several ranges
    want = {r.id: r.q for r in builtin_ntile(df, 5, order, "q").collect()}
    assert {r.id: r.q for r in range_ntile(df, 5, order, "q").collect()} == want


@pytest.mark.parametrize("n,k,ties", [(0, 5, 1), (1, 5, 1), (3, 5, 1), (5, 4, 1), (1237, 5, 7), (1500, 4, 86)])
def test_cuts_equal_builtin(spark, n, k, ties):
    df = spark.range(n).select(F.col("id"), (F.col("id") % ties).alias("v"), F.when(F.col("id") % 11 == 0, None).otherwise(F.col("id") % 13).alias("w"))
    specs = [("q", k, [desc("v"), asc("w"), asc("id")]), ("r", 3, [asc("w"), desc("id")])]
    want = sorted(tuple(r) for r in ntile_columns(df, specs, method="builtin").collect())
    assert sorted(tuple(r) for r in cut_ntiles(df, specs, stored=True).collect()) == want
    assert sorted(tuple(r) for r in cut_ntiles(df, specs).collect()) == want


def test_cuts_by_refined_pivots_equal_builtin(spark, monkeypatch):
    monkeypatch.setattr(ranking, "SORTED_AT_ONCE", 40)          # several passes of seven pivots
    monkeypatch.setattr(ranking, "_STEPS", 3)
    df = spark.range(3000).select("id", F.when(F.col("id") < 1500, 0).otherwise(F.col("id") % 97).alias("v"), (F.col("id") % 2).alias("w"))
    specs = [("a", 5, [desc("v"), asc("id")]), ("b", 4, [asc("w"), desc("id")]), ("c", 7, [asc("id")])]
    want = sorted(tuple(r) for r in ntile_columns(df, specs, method="builtin").collect())
    assert sorted(tuple(r) for r in cut_ntiles(df, specs, stored=True).collect()) == want


def test_the_search_between_pivots_keeps_its_size_where_it_is_pushed_down(spark, monkeypatch):
    monkeypatch.setattr(ranking, "SORTED_AT_ONCE", 40)
    df = spark.range(500).select("id", (F.col("id") % 97).alias("v"))
    out = cut_ntiles(df, [("a", 5, [desc("v"), asc("id")]), ("b", 4, [asc("id")])], stored=True)
    assert len(out._jdf.queryExecution().optimizedPlan().toString()) < 50_000
    want = ntile_columns(df, [("a", 5, [desc("v"), asc("id")]), ("b", 4, [asc("id")])], method="builtin")
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, want.collect()))


def test_rows_that_agree_in_the_whole_order_still_fill_the_buckets_evenly(spark):
    got = cut_ntiles(spark.range(23).select(F.lit(7).alias("v")), [("q", 5, [asc("v")])]).groupBy("q").count().collect()
    assert {r["q"]: r["count"] for r in got} == {1: 5, 2: 5, 3: 5, 4: 4, 5: 4}


@pytest.mark.parametrize("kind", ["int", "bigint", "double", "decimal(12,3)", "string", "boolean", "date", "timestamp", "timestamp_ntz"])
def test_sort_tuples_order_every_type_as_spark_does(spark, kind):
    raw = ["-5", "3", "0", "12", "7"] if kind in ("int", "bigint") else ["-5.5", "3.25", "-0.0", "0.0", "1e3", "12"]
    raw = {"double": raw + ["NaN", "Infinity", "-Infinity"], "decimal(12,3)": raw, "string": ["", "a", "ab", "b", "é", "a\x00", "\U0001F642"],
           "boolean": ["true", "false"], "date": ["1969-12-31", "1970-01-01", "2024-02-29"], "int": raw, "bigint": raw + [str(-2**63), str(2**63 - 1)],
           "timestamp": ["1969-12-31 23:59:59.5", "2024-01-01 00:00:00", "2024-01-01 00:00:00.000001"],
           "timestamp_ntz": ["1969-12-31 23:59:59.5", "2024-01-01 00:00:00", "2024-01-01 00:00:00.000001"]}[kind]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(raw + [None])], "id int, t string").select("id", F.col("t").cast(kind).alias("v"))
    for ascending in (True, False):
        for nulls_first in (True, False):
            order = [SortKey("v", ascending, nulls_first), asc("id")]
            want = [r.id for r in df.orderBy(*[o.expr() for o in order]).collect()]
            assert [r.id for r in df.orderBy(ranking.sort_tuple(df, order)).collect()] == want


def test_cuts_shuffle_no_row_of_the_table(spark):
    df = spark.range(1000).select("id", (F.col("id") % 7).alias("v"), F.lit("payload").alias("text"))
    plan = cut_ntiles(df, [("q", 5, [asc("v"), asc("id")])], stored=True)._jdf.queryExecution().executedPlan().toString()
    assert all("text" not in line for line in plan.splitlines() if "Exchange" in line)
