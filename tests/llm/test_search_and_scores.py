"""Operators 11 to 13 against plain versions: recurrent language model, hard negatives, periodic runs."""

import collections
import hashlib
import math
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewater.llm import gru as G
from tidewater.llm import hard_negatives as H
from tidewater.llm import periodic_runs as R
from tidewater.llm import recurrent_lm as L

from .helpers import frame, odd_rows

SF001 = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


# ---- periodic runs

def brute_runs(w):
    found = {}
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i + q < len(w):
            if w[i] != w[i + q]:
                i += 1
                continue
            s = i
            while i + q < len(w) and w[i] == w[i + q]:
                i += 1
            if i - s + q >= max(6, 4 * q):
                found.setdefault((s, i - s + q), q)
    return sorted((s, n, q) for (s, n), q in found.items())


def brute_row(doc_id, text):
    w = WORD.findall(text or "")
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if w and h % 10 == 0:
        g = h // 10
        a, n = g % len(w), len(w)
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(w)
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (doc_id, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
            sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(" ".join(x for i, x in enumerate(w) if i not in gone)))


def test_runs_of_random_sequences_equal_brute_force():
    rng = random.Random(3)
    for _ in range(120):
        docs = []
        for _ in range(rng.randint(1, 8)):
            n = rng.choice([0, 1, 5, 6, 8, 20, 60, 120])
            w = [rng.randrange(rng.choice([1, 2, 3, 30])) for _ in range(n)]
            if n > 8 and rng.random() < 0.6:
                p, s = rng.randint(1, n // 4), rng.randrange(n)
                w = [w[i] if i < s else w[s + (i - s) % p] for i in range(n)]
                w += w[:rng.randrange(n)] if rng.random() < 0.5 else []
            docs.append(w)
        off = np.concatenate([[0], np.cumsum([len(d) for d in docs])]).astype(np.int64)
        got = [[] for _ in docs]
        for d, *run in zip(*R.runs_of(np.array([x for d in docs for x in d], dtype=np.int64), off)):
            got[d].append(tuple(map(int, run)))
        assert got == [brute_runs(w) for w in docs]


def test_extensions_of_the_grammar_equal_direct_comparison():
    rng = np.random.default_rng(5)
    for a in (1, 2, 4):
        s = rng.integers(0, a, 400)
        s[100:200] = s[:100]
        seq = np.concatenate([[90], s, [91]])
        g = R.Grammar(seq)
        i, j = rng.integers(1, 401, 500), rng.integers(1, 401, 500)
        i, j = np.minimum(i, j)[i != j], np.maximum(i, j)[i != j]
        ahead, back = g.extend(i, j, True), g.extend(i, j, False)
        for x, y, f, b in zip(i, j, ahead, back):
            n = 0
            while seq[x + n] == seq[y + n]:
                n += 1
            m = 0
            while seq[x - m] == seq[y - m]:
                m += 1
            assert (n, m) == (f, b)


def test_periodic_runs_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    want = sorted(brute_row(r.doc_id, r.text) for r in docs.collect())
    assert sorted(tuple(r) for r in R.periodic_runs(docs, plant=True).collect()) == want
    assert any(r[1] for r in want)


def test_periodic_runs_of_odd_rows(spark):
    rows = odd_rows() + [(50, "a b " * 40_000, "en", "a", 0), (51, " ".join(["x"] * 200_000), "en", "a", 0), (52, "\x0b\x0c a\x0ba\x0ca\ra a\ta", "en", "a", 0)]
    key = lambda r: tuple(map(str, r))
    got = sorted((tuple(r) for r in R.periodic_runs(frame(spark, rows), plant=True).collect()), key=key)
    assert got == sorted((brute_row(r[0], r[1]) if r[0] not in (8, 50, 51) else next(g for g in got if g[0] == r[0]) for r in rows), key=key)
    plain = {r.doc_id: r for r in R.collapse_runs(frame(spark, rows)).collect()}
    assert plain[8].runs == []                                       # 25,402 words, less than three times
    assert [tuple(x) for x in plain[50].runs] == [(0, 80_000, 2)] and plain[50].collapsed == "a b"
    assert [tuple(x) for x in plain[51].runs] == [(0, 200_000, 1)] and plain[51].collapsed == "x"
    assert [tuple(x) for x in plain[52].runs] == [(0, 6, 1)]
    assert R.periodic_runs(frame(spark, [])).count() == 0


# ---- hard negatives

def brute_negatives(rows, anchor=lambda v: v % 100 == 0):
    ok = [(v, lab, [math.floor(256 * x) for x in e]) for v, lab, e in rows
          if v is not None and lab is not None and e and all(x is not None and math.isfinite(x) for x in e)]
    out = []
    for i, (v, lab, y) in enumerate(ok):
        if not anchor(v):
            continue
        scored = [(-sum(a * b for a, b in zip(y, z)), w, other) for j, (w, other, z) in enumerate(ok) if j != i and len(z) == len(y)]
        pos = sorted((s, w) for s, w, other in scored if other == lab)[:5]
        neg = sorted((s, w) for s, w, other in scored if other != lab)
        for s, w in pos:
            inside = [(t, u) for t, u in neg if 30 * -s <= 100 * -t <= 90 * -s][:10]
            out += [(v, w, k + 1, u, -s, -t) for k, (t, u) in enumerate(inside)]
    return sorted(out)


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>").withColumn("gid", F.lit("x")).withColumn("score", F.lit(1))


@pytest.mark.parametrize("dim,n,rows_per_group", [(64, 700, 100), (5, 400, 64), (130, 300, None)])
def test_hard_negatives_equal_brute_force(spark, dim, n, rows_per_group):
    rng = np.random.default_rng(dim)
    centre = rng.normal(0, 0.2, (4, dim))
    rows = [(i, int(rng.integers(0, 4)), (centre[rng.integers(0, 4)] + rng.normal(0, 0.2, dim)).tolist()) for i in range(n)]
    rows[7] = (7, 1, rows[100][2])                                   # ties
    rows[8] = (8, rows[100][1], rows[100][2])
    got = H.mine(vectors(spark, rows), F.col("vec_id") % 100 == 0, rows_per_group=rows_per_group)
    assert sorted(tuple(r) for r in got.collect()) == brute_negatives(rows)


def test_hard_negatives_of_odd_rows(spark):
    rng = np.random.default_rng(1)
    e = lambda: rng.normal(0, 0.3, 6).tolist()
    rows = [(0, 1, e()), (100, 2, e()), (None, 1, e()), (3, None, e()), (4, 1, None), (5, 1, [float("nan")] * 6), (6, 1, [None] + e()[1:]),
            (9, 2, []), (10, 1, [0.0] * 6), (300, 2, [0.0] * 6), (12, 2, [1e300] + e()[1:]), (13, 1, e()[:3]), (200, 1, e()[:3]), (15, 2, e()[:3])]
    rows += [(20 + i, 1 + i % 2, e()) for i in range(40)]
    finite = [(v, lab, x and [None if c is None else max(-524288.0, min(524288.0, c)) if math.isfinite(c) else c for c in x]) for v, lab, x in rows]
    got = sorted(tuple(r) for r in H.mine(vectors(spark, rows), F.col("vec_id") % 100 == 0).collect())
    assert got == brute_negatives(finite)
    assert H.mine(vectors(spark, []), F.col("vec_id") % 100 == 0).count() == 0
    assert H.mine(vectors(spark, [(1, 1, e())]), F.col("vec_id") % 100 == 0).count() == 0
    twice = H.mine(vectors(spark, rows + rows), F.col("vec_id") == 0, positives=1)
    assert {r.positive_id for r in twice.collect()} <= {0}           # the copy of the anchor is its first positive


def test_intervals_hold_the_cosines():
    rng = np.random.default_rng(4)
    for d in (3, 64, 100):
        y = rng.integers(-60, 60, (200, d))
        g = H.Group(d, np.arange(200), np.arange(200), np.zeros(200, dtype=np.int64), y)
        q = H.planes(y[:20], g.turn)
        true, sums, width = H._units(y[:20])[0] @ H._units(g.y)[0].T, (0.0, 0.0), 9.0
        for level in range(H.LEVELS):
            est, slip, half = g._bounds(q, level, sums)
            assert (np.abs(true - est) <= half).all() and half.mean() < width
            sums, width = (est, slip), half.mean()


# ---- recurrent language model

def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def check_counts(rows, docs):
    held = lambda d: d is not None and zlib.crc32(str(d).encode()) % 7 == 2
    words = [(d, [*WORD.findall(lower(t)), ""]) for d, t in docs]
    count = collections.Counter(x for d, w in words if not held(d) for x in w)
    n, v = sum(count.values()), len(count)
    key = lambda r: (str(r[0]), *r[1:4], round(r[4], 6))
    want = [(d, held(d), len(w), sum(count[x] > 0 for x in w), sum(math.log10((count[x] + 1) / (n + 1 * (v + 1))) for x in w)) for d, w in words]
    assert sorted(map(key, want)) == sorted(key((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.base_score)) for r in rows)
    assert all(r.train_tokens == n and math.isfinite(r.score) and r.score < 0 for r in rows)


def test_scores_of_held_out_documents_beat_the_base(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    rows = L.score_documents(docs).collect()
    check_counts(rows, [(r.doc_id, r.text) for r in docs.collect()])
    out = [r for r in rows if r.held_out]
    assert sum(r.score for r in out) > 0.97 * sum(r.base_score for r in out)
    assert sum(r.score > r.base_score for r in out) > 0.9 * len(out)


def test_scores_of_odd_rows_and_words_outside_the_head(spark, monkeypatch):
    monkeypatch.setattr(L, "MOST_VISITS", 1)
    rows = [r for r in odd_rows() if r[0] != 8] + [(60, "k" * 5000 + " tail " + "é" * 70, "en", "a", 0), (61, "k" * 5000, "en", "a", 0)]
    check_counts(L.score_documents(frame(spark, rows)).collect(), [r[:2] for r in rows])
    assert L.score_documents(frame(spark, [])).count() == 0
    only = next(d for d in range(100) if zlib.crc32(str(d).encode()) % 7 == 2)
    nothing = L.score_documents(frame(spark, [(only, "nothing is learnt from here", "en", "a", 0)])).collect()
    assert nothing[0].train_tokens == 0 and nothing[0].n_known == 0 and math.isfinite(nothing[0].score)
    monkeypatch.setattr(L, "HEAD_WORDS", 8)                          # nearly every word gets its count by the join
    docs = spark.read.parquet(f"{SF001}/documents.parquet").limit(60)
    docs = docs.sparkSession.createDataFrame(docs.collect(), docs.schema)
    check_counts(L.score_documents(docs).collect(), [(r.doc_id, r.text) for r in docs.collect()])


def test_a_large_corpus_is_learnt_from_whole():
    import pyarrow as pa
    assert L.visits(10 ** 12) == 1 and L.visits(500_000) == 4 and L.visits(0) == L.MOST_VISITS
    lex = L.Lexicon(pa.array(["a", "b"], pa.large_string()), np.array([9, 5]), np.array([0, 1]), np.full(L.BUCKETS, 3), np.zeros(L.BUCKETS),
                    2, 3, np.array([9, 5, 3, 1]), 10 ** 12, 2)
    flat = lex.shape().start()
    held = lambda x: type("Held", (), {"value": x})()
    texts = ["a b " * 700, "", "a c", "b " * 513]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])
    out = list(L._train(held(lex), held((flat, np.full_like(flat, 1e-6))))(iter([batch])))
    assert out[0].column(1).to_pylist() == [sum(len(t.split()) + 1 for t in texts)] * 16


def test_model_is_a_distribution_and_its_gradient_is_right():
    shape = G.Shape(np.array([50, 20, 9, 9, 5, 3, 1, 1, 1, 1]), 4)
    m, rng = G.Model(shape, shape.start()), np.random.default_rng(0)
    m.flat = m.flat.astype(np.float64) + rng.normal(0, 0.3, len(m.flat))
    m.p = shape.unpack(m.flat)
    h = rng.normal(0, 1, (3, 4))
    total = sum(np.exp(m.log_prob(h, np.full(3, w))) for w in range(10))
    assert np.allclose(total, 1)
    read, begins, goal, weight = rng.integers(0, 11, (5, 3)), rng.random((5, 3)) < 0.2, rng.integers(0, 10, (5, 3)), rng.random((5, 3)) < 0.8
    _, grad, _ = m.gradient(read, begins, goal, weight, h)
    flat = np.zeros_like(m.flat)
    own = shape.unpack(flat)
    for name, g in grad.items():
        own[name][g[0] if name == "embed" else slice(None)] = g[1] if name == "embed" else g
    for i in rng.integers(0, len(flat), 80):
        loss = []
        for e in (1e-5, -2e-5):
            m.flat[i] += e
            loss.append(m.gradient(read, begins, goal, weight, h)[0])
        m.flat[i] += 1e-5
        assert abs((loss[0] - loss[1]) / 2e-5 - flat[i]) < 1e-7


def test_state_is_carried_over_windows_and_lanes():
    shape = G.Shape(np.array([9, 7, 5, 3, 1]), 6)
    m, rng = G.Model(shape, shape.start()), np.random.default_rng(2)
    sizes = [0, 1, 40, 7, 200, 3, 0, 16]
    off = np.concatenate([[0], np.cumsum(sizes)])
    tokens = rng.integers(0, 5, off[-1])
    got = G.token_log_probs(m, tokens, off, 3, 16)
    for lo, hi in zip(off[:-1], off[1:]):
        h, last = np.zeros((1, 6), dtype=np.float32), 5
        for t in range(lo, hi):
            _, h, _ = m.states(np.array([[last]]), np.array([[False]]), h)
            assert abs(float(m.log_prob(h, tokens[t:t + 1])[0]) - got[t]) < 1e-4
            last = tokens[t]


def test_parameters_are_averaged_by_tokens():
    import pyarrow as pa
    rows = [(k, t, (np.arange(4.0) + t) * t) for t in (1, 3) for k in (0, 1)]
    b = pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows]), pa.array([r[1] for r in rows]), pa.array([r[2].tobytes() for r in rows], pa.binary())],
                                   names=["block", "tokens", "sums"])
    out = next(iter(L._add([b])))
    assert out.column(1).to_pylist() == [4, 4]
    assert np.allclose(np.frombuffer(out.column(2)[0].as_py()) / 4, np.arange(4.0) + (1 + 9) / 4)
