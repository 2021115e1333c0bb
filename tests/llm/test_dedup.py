import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from tidewater.llm import exact_dedup as X
from tidewater.llm import grid_join as G
from tidewater.llm import simhash as S
from tidewater.llm.components import components

from .helpers import frame, odd_rows


def groups_of(n, pairs):
    root = list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for a, b in pairs:
        root[find(a)] = find(b)
    return [find(i) for i in range(n)]


def test_components_match_union_find(spark):
    r = random.Random(5)
    pairs = [(r.randrange(300), r.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(300, 340)] + [(7, 7)]
    got = {x.node: x.component for x in components(spark.createDataFrame(pairs, "u long, v long")).collect()}
    root = groups_of(341, pairs)
    low = {}
    for i in range(341):
        low.setdefault(root[i], i)
    linked = {i for a, b in pairs if a != b for i in (a, b)}
    assert got == {i: low[root[i]] for i in linked}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


# --- exact -----------------------------------------------------------------------------------

def exact_expected(rows):
    by = {}
    for r in rows:
        by.setdefault(r[1] or "", []).append(r[0])
    key = lambda d: -1 if d is None else d
    return sorted(((key(r[0]), max(by[r[1] or ""], key=key), len(by[r[1] or ""]), hashlib.sha256((r[1] or "").encode()).hexdigest())
                   for r in rows), key=str)


def test_exact_duplicates_on_awkward_rows(spark):
    rows = odd_rows()
    got = X.exact_duplicates(frame(spark)).collect()
    assert sorted(((-1 if g.doc_id is None else g.doc_id, g.keep_id, g.group_size, g.text_sha256) for g in got), key=str) == exact_expected(rows)
    assert sum(g.kept for g in got) == len({r[1] or "" for r in rows})          # one row of each text, also of repeated rows
    left = X.drop_exact_duplicates(frame(spark))
    assert left.columns == frame(spark).columns
    assert sorted(x.text or "" for x in left.collect()) == sorted({r[1] or "" for r in rows})
    assert X.exact_duplicates(frame(spark, [])).count() == 0
    assert X.drop_exact_duplicates(frame(spark, [])).count() == 0


def test_texts_that_share_a_digest_stay_apart(spark, monkeypatch):
    monkeypatch.setattr(X, "_digest", lambda df: df.withColumn("__tw_digest", F.unhex(F.lit("00"))))
    rows = odd_rows()
    got = X.exact_duplicates(frame(spark)).collect()
    assert sorted([e[:3] for e in exact_expected(rows)], key=str) == sorted(
        ((-1 if g.doc_id is None else g.doc_id, g.keep_id, g.group_size) for g in got), key=str)
    assert sum(g.kept for g in got) == len({r[1] or "" for r in rows})


def test_state_continues_with_later_arrivals(spark, tmp_dir):
    folder, path = tmp_dir("state"), tmp_dir("arrivals")
    schema = "__tw_digest binary, doc_id long, __tw_file long, __tw_row long"
    for batch in ([(b"a", 1, 0, 0), (b"b", 2, 0, 1)], [(b"a", 9, 1, 0)]):
        spark.createDataFrame([(bytearray(d), *r) for d, *r in batch], schema).write.mode("append").parquet(path)
        X.run_state(path, spark.read.parquet(path).schema, folder, spark)
    last = spark.read.parquet(f"{folder}/groups").where("batch = 1").collect()
    assert [(bytes(r["__tw_digest"]), r.keeper.doc_id, r.group_size) for r in last] == [(b"a", 9, 2)]


@pytest.mark.parametrize("shared", [False, True])
def test_later_arrivals_are_compared_with_the_texts_kept_before(spark, tmp_dir, monkeypatch, shared):
    """Also where every text has the same digest, so that only the bytes tell them apart."""
    if shared:
        monkeypatch.setattr(X, "_digest", lambda df: df.withColumn("__tw_digest", F.unhex(F.lit("00"))))
    folder, seen = tmp_dir("dedup-folder"), []
    arrivals = [[(5, "x"), (6, "y"), (7, "y"), (8, None)], [(1, "x"), (2, "z"), (9, "y"), (3, "")], [(4, "z"), (10, "w"), (0, "x")]]
    for i, rows in enumerate(arrivals):
        path = tmp_dir(f"arrival-{i}")
        spark.createDataFrame(rows, "doc_id long, text string").write.parquet(path)
        got = {g.doc_id: (g.keep_id, g.group_size, g.kept) for g in X.exact_duplicates(spark.read.parquet(path), folder).collect()}
        seen += rows
        same = lambda t: [d for d, u in seen if (u or "") == (t or "")]
        assert got == {d: (max(same(t)), len(same(t)), d == max(same(t))) for d, t in rows}


def test_a_kept_text_that_is_gone_stops_the_run(spark, tmp_dir):
    from tidewater.session import delete_path
    folder, paths = tmp_dir("gone-folder"), [tmp_dir("gone-0"), tmp_dir("gone-1")]
    for path, doc_id in zip(paths, (9, 1)):
        spark.createDataFrame([(doc_id, "x")], "doc_id long, text string").write.parquet(path)
    X.exact_duplicates(spark.read.parquet(paths[0]), folder).collect()
    delete_path(spark, paths[0])
    with pytest.raises(Exception):
        X.exact_duplicates(spark.read.parquet(paths[1]), folder).collect()


# --- SimHash ---------------------------------------------------------------------------------

def fingerprint(text):
    t = (text or "").translate({65 + i: 97 + i for i in range(26)})
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    sh = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else ([" ".join(w)] if w else [])
    ones = np.zeros(64, int)
    for s in sh:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        ones += [(h >> i) & 1 for i in range(64)]
    return sum(1 << i for i in range(64) if 2 * ones[i] > len(sh))


def test_fingerprints_match_definition():
    texts = [r[1] for r in odd_rows()] + ["a", "A b", " x\ty\nz ", "É É É", ""]
    got = S.fingerprints_of(pa.array(texts), chunk=1000)
    assert [int(g) for g in got] == [fingerprint(t) for t in texts]


def test_golay_code_is_perfect():
    table = S.golay_decoder()
    assert np.bincount(table).tolist() == [2048] * 4096


def test_links_equal_brute_force(spark):
    rng = np.random.default_rng(0)
    base = rng.integers(0, 2**63, 150, dtype=np.int64) * 2 + rng.integers(0, 2, 150)
    all_fp = [base]
    for k in (1, 2, 3):
        m = base.copy().view(np.uint64)
        for i in range(len(m)):
            for b in rng.choice(64, k, replace=False):
                m[i] ^= np.uint64(1 << int(b))
        all_fp.append(m.view(np.int64))
    fps = np.unique(np.concatenate(all_fp))
    x = fps.view(np.uint64)
    near = {(int(min(fps[i], fps[j])), int(max(fps[i], fps[j]))) for i in range(len(x)) for j in range(i)
            if bin(int(x[i]) ^ int(x[j])).count("1") <= 2}
    got = [(r.u, r.v) for r in S.links(spark.createDataFrame([(int(v),) for v in fps], "fp long")).collect()]
    assert len(got) == len(set(got)) and set(got) == near


def test_simhash_groups_on_awkward_rows(spark):
    rows = odd_rows()
    got = S.near_duplicates(frame(spark)).collect()
    fps = [fingerprint(r[1]) for r in rows]
    root = groups_of(len(rows), [(i, j) for i in range(len(rows)) for j in range(i) if bin(fps[i] ^ fps[j]).count("1") <= 2])
    low = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            low[root[i]] = min(low.get(root[i], r[0]), r[0])
    want = sorted(((r[0], f"{fps[i]:016x}", low.get(root[i])) for i, r in enumerate(rows)), key=str)
    assert sorted(((g.doc_id, g.fingerprint, g.component_id) for g in got), key=str) == want
    kept = S.drop_near_duplicates(frame(spark))
    assert kept.columns == frame(spark).columns and kept.count() == len(set(root))
    assert S.near_duplicates(frame(spark, [])).count() == 0 and S.drop_near_duplicates(frame(spark, [])).count() == 0


# --- embeddings ------------------------------------------------------------------------------

def vector_groups(rows, least=0.98):
    ok = [i for i, (_, e, label) in enumerate(rows) if label is not None and e and all(x is not None and np.isfinite(x) for x in e) and any(e)]
    pairs = []
    for n, i in enumerate(ok):
        for j in ok[:n]:
            if rows[i][2] == rows[j][2] and len(rows[i][1]) == len(rows[j][1]):
                x, y = np.array(rows[i][1], float), np.array(rows[j][1], float)
                if x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= least:
                    pairs.append((i, j))
    links = [0] * len(rows)
    for i, j in pairs:
        links[i] += 1
        links[j] += 1
    root, low = groups_of(len(rows), pairs), {}
    for i, r in enumerate(rows):
        low[root[i]] = min(low.get(root[i], r[0]), r[0])
    return sorted((r[0], links[i], low[root[i]], r[0] == low[root[i]]) for i, r in enumerate(rows))


@pytest.mark.parametrize("block_rows", [8, 1024])
def test_grid_join_equals_brute_force(spark, block_rows):
    rng = np.random.default_rng(0)
    rows = []
    for i in range(150):
        base = rng.normal(size=5) if i % 4 else np.array([1.0, 2, 3, 4, 5])
        v = (base + rng.normal(size=5) * 0.15) if i % 3 else base
        rows.append((i, [float(np.float32(x)) for x in v], int(rng.integers(0, 2)) if i % 11 else None))
    rows += [(200, None, 1), (201, [0.0] * 5, 1), (202, [1.0, None, 2.0, 3.0, 4.0], 1), (203, [float("nan")] * 5, 1), (204, [1.0, 2.0], 1),
             (205, [2.0, 4.0], 1), (206, [], 1), (207, [float("inf")] + [1.0] * 4, 0), (208, [1e30, 2e30], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumn("gid", F.lit("x")).withColumn("n", F.lit(1))
    got = sorted(tuple(r)[:4] for r in G.near_duplicates(df, block_rows=block_rows).collect())
    assert got == vector_groups([(r.vec_id, r.embedding, r.label) for r in df.collect()])
    assert G.near_duplicates(df.limit(0)).count() == 0


def test_interval_join_skips_no_link():
    rng = np.random.default_rng(3)
    x = G._unit(np.repeat(rng.normal(size=(40, 6)), 5, axis=0) + rng.normal(size=(200, 6)) * 0.05)
    eps = float(np.sqrt(2 - 2 * 0.98))
    order = np.lexsort(np.floor(x[:, :3] / eps).T[::-1])
    x = x[order]
    i, j = G.join_intervals(x, x[:, :3], x, x[:, :3], eps, 0.98, True, leaf=8)
    a, b = np.nonzero(np.triu(x @ x.T >= 0.98, 1))
    assert set(zip(i.tolist(), j.tolist())) == set(zip(a.tolist(), b.tolist()))
