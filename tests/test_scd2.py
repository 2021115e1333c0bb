import datetime as dt
import random

from hypothesis import given, settings
from hypothesis import strategies as st

from tidewater.operators.scd2 import closed, current, scd2

SCHEMA = "k int, seq long, t string, u string"


def _run(spark, rows, segments=None):
    df = spark.createDataFrame(rows, SCHEMA)
    out = scd2(df, ["k"], "seq", ["t"], segments=segments)
    return _sorted((r.k, r.t, r.u, r["__START_AT"], r["__END_AT"]) for r in out.collect())


def _key(v):
    return (v is not None, v)


def _sorted(rows):
    return sorted(rows, key=lambda t: tuple(_key(v) for v in t))


def brute_scd2(rows):
    """Reference definition, row by row, in plain Python."""
    best = {}
    for k, s, t, u in rows:
        if k is None or s is None:
            continue
        cur = best.get((k, s))
        if cur is None or (_key(t), _key(u)) > (_key(cur[0]), _key(cur[1])):
            best[(k, s)] = (t, u)
    out = []
    for k in sorted({k for k, _ in best}):
        seqs = sorted(s for kk, s in best if kk == k)
        versions = []
        for s in seqs:
            t, u = best[(k, s)]
            if not versions or versions[-1]["t"] != t:
                versions.append({"t": t, "u": u, "start": s})
            else:
                versions[-1]["u"] = u
        for i, v in enumerate(versions):
            end = versions[i + 1]["start"] if i + 1 < len(versions) else None
            out.append((k, v["t"], v["u"], v["start"], end))
    return _sorted(out)


def test_late_row(spark):
    rows = [(1, 1, "A", "a"), (1, 3, "A", "b"), (1, 2, "B", "c")]
    assert _run(spark, rows) == _sorted([(1, "A", "a", 1, 2), (1, "A", "b", 3, None), (1, "B", "c", 2, 3)])


def test_untracked_change_keeps_one_version(spark):
    rows = [(1, 1, "A", "old"), (1, 2, "A", "new")]
    assert _run(spark, rows) == _sorted([(1, "A", "new", 1, None)])


def test_tie_is_deterministic(spark):
    rows = [(1, 5, "A", "x"), (1, 5, "B", "y")]
    for perm in (rows, rows[::-1]):
        assert _run(spark, perm) == _sorted([(1, "B", "y", 5, None)])


def test_null_tracked_values(spark):
    rows = [(1, 1, None, "a"), (1, 2, "x", "b"), (1, 3, None, "c")]
    assert _run(spark, rows) == _sorted([(1, None, "a", 1, 2), (1, None, "c", 3, None), (1, "x", "b", 2, 3)])


def test_null_key_or_sequence_ignored(spark):
    rows = [(None, 1, "A", "a"), (1, None, "A", "a"), (1, 2, "A", "z")]
    assert _run(spark, rows) == _sorted([(1, "A", "z", 2, None)])


def test_timestamp_sequence_and_views(spark):
    t0 = dt.datetime(2024, 1, 1)
    rows = [(1, t0 + dt.timedelta(hours=h), s) for h, s in [(0, "a"), (5, "a"), (30, "b"), (80, "a")]]
    df = spark.createDataFrame(rows, "k int, ts timestamp_ntz, t string")
    h = scd2(df, ["k"], "ts", ["t"], segments=3)
    assert h.count() == 3
    assert current(h).count() == 1 and closed(h).count() == 2


events = st.lists(st.tuples(st.integers(0, 3), st.integers(0, 40), st.sampled_from(["A", "B", None]),
                            st.sampled_from(["p", "q", "r", None])), min_size=1, max_size=40)


@settings(max_examples=8, deadline=None)
@given(events)
def test_matches_brute_force_any_split(spark, rows):
    expected = brute_scd2(rows)
    # 40 segments cut every key with two rows, 6 only the larger ones, 1 none
    for n in (40, 6, 1):
        assert _run(spark, rows, segments=n) == expected


@settings(max_examples=5, deadline=None)
@given(events, st.randoms(use_true_random=False))
def test_order_and_batching_do_not_matter(spark, rows, rnd):
    shuffled = list(rows)
    rnd.shuffle(shuffled)
    cut = rnd.randint(0, len(rows))
    assert _run(spark, shuffled[:cut] + shuffled[cut:], segments=12) == brute_scd2(rows)


def test_contiguous_intervals_on_events(spark):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet").select("user_id", "ts", "event_type", "value")
    h = scd2(ev, ["user_id"], "ts", ["event_type"]).collect()
    by_key = {}
    for r in h:
        by_key.setdefault(r.user_id, []).append((r["__START_AT"], r["__END_AT"]))
    random.seed(0)
    for k, iv in by_key.items():
        iv.sort()
        assert iv[-1][1] is None
        assert sum(e is None for _, e in iv) == 1
        for (s1, e1), (s2, _) in zip(iv, iv[1:]):
            assert e1 == s2 and s1 < e1


def test_hot_key_is_cut_and_the_work_is_linear(spark):
    import time

    from pyspark.sql import functions as F

    from tidewater.operators.scd2 import hot_key_cuts
    n = 200_000
    base = spark.range(n).select(F.col("id").alias("seq"), (F.xxhash64("id") % 5).alias("t"), F.col("id").alias("u"))
    one, many = base.withColumn("k", F.lit(1)), base.withColumn("k", F.col("seq") % 10_000)
    cuts = hot_key_cuts(one, ["k"], "seq", 16)
    assert len(cuts) == 1 and 12 <= len(next(iter(cuts.values()))) <= 16 and not hot_key_cuts(many, ["k"], "seq", 16)
    seconds = {}
    for name, df in (("warm", one), ("one", one), ("many", many)):
        t0 = time.perf_counter()
        scd2(df, ["k"], "seq", ["t"]).write.format("noop").mode("overwrite").save()
        seconds[name] = time.perf_counter() - t0
    assert seconds["one"] < 4 * seconds["many"] + 2          # a quadratic frame takes minutes here
    h = scd2(one, ["k"], "seq", ["t"])
    opened = [(a, b) for a, b in zip([None] + base.orderBy("seq").limit(5000).toPandas()["t"].tolist(), base.orderBy("seq").limit(5000).toPandas()["t"].tolist()) if a != b]
    assert h.where("__START_AT < 5000").count() == len(opened)
    assert current(h).count() == 1 and h.where("__END_AT is not null and __END_AT <= __START_AT").count() == 0


def test_without_hot_keys_one_shuffle_and_one_sort(spark):
    df = spark.range(4000).selectExpr("id % 1000 AS k", "id AS seq", "id % 3 AS t")
    plan = scd2(df, ["k"], "seq", ["t"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("Sort [") == 1


def test_tasks_grow_with_the_rows(spark, monkeypatch):
    from tidewater import session
    monkeypatch.setattr(session, "ROWS_OF_A_TASK", 100)
    df = spark.range(4000).selectExpr("id % 1000 AS k", "id AS seq", "id % 3 AS t")
    plan = scd2(df, ["k"], "seq", ["t"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "hashpartitioning(k#" in plan and ", 40)" in plan and plan.count("Sort [") == 1
    rows = [(k, i, "AB"[i % 7 % 2], str(i)) for k in range(40) for i in range(30)] + [(99, i, "AB"[i // 5 % 2], "") for i in range(1500)]
    assert _run(spark, rows, segments=None) == brute_scd2(rows)          # 99 is cut into pieces of about 100 rows


def test_joins_of_many_lines_start_with_more_partitions(spark, monkeypatch):
    from tidewater import session
    name = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    monkeypatch.setattr(session, "ROWS_OF_A_TASK", 100)
    try:
        session.room_for(spark, 800)                    # no more than the session's 8
        assert spark.conf.get(name, None) is None
        session.room_for(spark, 1201)
        session.room_for(spark, 900)
        assert spark.conf.get(name) == "13"
    finally:
        spark.conf.unset(name)


def test_hot_key_with_nulls_ties_and_versions_over_many_segments(spark):
    rows = [(1, i, None if 100 < i < 700 else "A" if i < 900 else "B", str(i)) for i in range(1000)] + [(1, 500, "Z", "tie")]
    rows += [(k, i, "x", "y") for k in range(2, 40) for i in range(3)]
    assert _run(spark, rows, segments=16) == brute_scd2(rows)


def _scanned(df):
    """Rows that the file scan of ``df`` handed on, by its own metric."""
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return leaves.apply(0).metrics().apply("numOutputRows").value()


def test_key_lookup_in_a_stored_dimension_opens_few_row_groups(spark, tmp_dir):
    from tidewater.operators.scd2 import key_history
    from tidewater.sinks.tables import write_keyed
    rows = spark.range(400_000).selectExpr("id * 7919 % 40000 * 2 key", "id at", "sha2(string(id), 256) state")
    spark.conf.set("parquet.block.size", str(256 << 10))
    try:
        path = write_keyed(rows, tmp_dir("keyed"), "key", 8)
    finally:
        spark.conf.unset("parquet.block.size")
    stored = spark.read.parquet(path)
    assert sorted(map(tuple, key_history(stored, "key", 4242).collect())) == sorted(map(tuple, key_history(rows, "key", 4242).collect()))
    assert 10 <= _scanned(key_history(stored, "key", 4242)) < 400_000 / 20
    assert _scanned(key_history(stored, "key", 4243)) == 0                  # inside a file's range, but not in its Bloom filter
