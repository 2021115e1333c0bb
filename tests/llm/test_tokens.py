import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidewater.llm import mixture as M
from tidewater.llm import packing as P
from tidewater.llm import wavelet as W
from tidewater.llm.tokens import encoder, tokenizer_path

from .helpers import frame, odd_rows

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(tokenizer_path())


def test_encoder_equals_library(library):
    r = random.Random(3)
    texts = [t for _, t, *_ in odd_rows()] + [
        None, "", "It's don't WE'LL 'Re x'y", "<|endoftext|> hi<|startoftext|>", "<|EndOfText|>", "ÉCOLE Straße İstanbul ǅ Σας ΣΑΣ K",
        "漢字 かな 12３４ ½ ²", "a\x02b \x02 ! !! a!b", "foo\x85bar\x1cbaz", "naïve,élan.ÀÉ-x_y", "ŉ ſ Ÿ ŒUVRE İİ × a×b ÷", "🙂👍🏽x", "ﬁne ﷽"]
    signs = list("aAéÉ'ßİı!.,-_ \n\t0９½ǅΣ́ͅ漢🙂|<>$×ŸŁł")
    texts += ["".join(r.choice(signs) for _ in range(r.randint(0, 25))) for _ in range(2000)]
    enc = encoder(tokenizer_path())
    want = [e.ids + [2] for e in library.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    for limit in (enc.limit, 50):                                   # also with a cache that is reset all the time
        enc.limit, kept = limit, enc.limit
        ids, off = enc.encode(pa.array(texts, pa.string()), 2)
        enc.limit = kept
        assert [ids[a:b].tolist() for a, b in zip(off, off[1:])] == want


def test_a_worker_keeps_one_encoder_for_each_cache_size(library):
    small = encoder(tokenizer_path(), 50)
    assert small is encoder(tokenizer_path(), 50) and small.limit == 50
    assert encoder(tokenizer_path()).limit == 400_000 and encoder(tokenizer_path(), W.KEPT_PARTS).limit > 400_000
    texts = [f"w{i} x{i * i}y" for i in range(500)]
    for enc in (small, encoder(tokenizer_path(), W.KEPT_PARTS)):
        ids, off = enc.encode(pa.array(texts), 2)
        assert [ids[a:b].tolist() for a, b in zip(off, off[1:])] == [e.ids + [2] for e in library.encode_batch(texts, add_special_tokens=False)]


# --- packing ---------------------------------------------------------------------------------

@pytest.mark.parametrize("n,kind", [(1, 0), (40, 0), (700, 0), (3000, 0), (500, 1), (500, 2), (300, 3)])
def test_plan_places_every_piece_once(n, kind):
    rng = np.random.default_rng(n + kind)
    length = {0: np.clip(rng.lognormal(6, 1, n), 1, 2048).astype(int), 1: rng.integers(600, 1100, n), 2: rng.integers(1, 60, n),
              3: np.full(n, 2048)}[kind]
    plan = P.Plan(np.bincount(length, minlength=2049))
    order = np.argsort(length, kind="stable")
    number = np.empty(n, dtype=np.int64)
    counts = np.bincount(length)
    number[order] = np.arange(n) - (np.cumsum(counts) - counts)[length[order]]
    seq, off = plan.place(length.astype(np.int64), number)
    held = defaultdict(list)
    for s, o, ell in zip(seq, off, length):
        held[s].append((o, ell))
    for parts in held.values():
        at = 0
        for o, ell in sorted(parts):
            assert o == at
            at += ell
        assert at <= 2048
    assert len(held) == plan.sequences
    bound = max(-(-int(length.sum()) // 2048), int((length > 1024).sum()))
    if kind in (0, 2):
        assert plan.sequences <= bound * 1.03 + 2


def test_configurations_cover_demand():
    sizes, demand = np.array([1500, 1100, 900, 700, 520]), np.array([10, 25, 40, 31, 60])
    plan = P.configurations(sizes, demand, 2048)
    assert (sum(c * n for c, n in plan) == demand).all() and all((c * sizes).sum() <= 2048 for c, _ in plan)


def pieces_expected(rows, library, end):
    out = []
    for (d, t, *_), e in zip(rows, library.encode_batch([r[1] or "" for r in rows], add_special_tokens=False)):
        ids = np.array(e.ids + [end], dtype="<u4")
        out += [(d, a // 2048, a, len(ids[a:a + 2048]), zlib.crc32(ids[a:a + 2048].tobytes())) for a in range(0, len(ids), 2048)]
    return sorted(out, key=str)


def check_packed(got):
    held = defaultdict(list)
    for g in got:
        held[g.sequence_id].append((g.offset, g.length))
    for parts in held.values():
        at = 0
        for o, ell in sorted(parts):
            assert o == at
            at += ell
        assert at <= 2048
    return len(held)


def test_pack_awkward_rows(spark, library):
    got = P.pack(frame(spark)).collect()
    assert sorted(((g.doc_id, g.piece, g.start, g.length, g.ids_crc32) for g in got), key=str) == pieces_expected(odd_rows(), library, 0)
    assert check_packed(got) <= -(-sum(g.length for g in got) // 2048) + 2
    assert P.pack(frame(spark, [])).count() == 0


def test_pack_documents(spark):
    got = P.pack(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).collect()
    assert check_packed(got) <= 1.02 * sum(g.length for g in got) / 2048 + 1


# --- wavelet matrix --------------------------------------------------------------------------

@pytest.mark.parametrize("n,planes,block", [(0, 16, 64), (1, 1, 64), (777, 16, 64), (5000, 6, 512), (3000, 20, 1 << 16)])
def test_shard_answers(n, planes, block):
    rng = np.random.default_rng(n)
    ids = rng.integers(0, min(1 << planes, 300) if n != 777 else 1 << planes, n).astype(np.uint32)
    blob = W.build(ids, np.array([5, 6]), np.array([0, 1]), np.array([n // 2, n - n // 2]), planes, block)
    s = W.Shard(blob, kept_blocks=3)
    assert np.array_equal(s.decode(), ids) and s.doc_ids.tolist() == [5, 6] and s.doc_n.sum() == n
    for i in rng.integers(0, n, 30) if n else []:
        assert s.access(int(i)) == ids[i]
    for token in {*ids[:20].tolist(), 1, 299, (1 << planes) + 3}:
        at = np.flatnonzero(ids == token)
        assert s.count(token) == len(at) and s.rank(token, n // 3) == (at < n // 3).sum()
        assert s.count(token, n // 4, n // 2) == ((at >= n // 4) & (at < n // 2)).sum()
        for k in (0, len(at) // 2, len(at) - 1, len(at)):
            assert s.select(token, k) == (at[k] if 0 <= k < len(at) else -1)
    with pytest.raises(ValueError):
        W.Shard(b"xxxx" + blob[4:])


@pytest.mark.parametrize("shard_ids", [50, 1 << 20])
def test_shards_round_trip(spark, library, shard_ids):
    rows = odd_rows()
    shards = W.write_shards(frame(spark), shard_ids=shard_ids)
    got = sorted(W.read_shards(shards).collect(), key=lambda g: g.start)
    ids = [np.array(e.ids + [2], dtype="<u4") for e in library.encode_batch([r[1] or "" for r in rows], add_special_tokens=False)]
    assert sorted(((g.doc_id, g.n_tokens, g.ids_crc32) for g in got), key=str) == sorted(
        ((r[0], len(x), zlib.crc32(x.tobytes())) for r, x in zip(rows, ids)), key=str)
    at = 0
    for g in got:                                                   # ascending doc_id, null first, no gap
        assert g.start == at
        at += g.n_tokens
    order = [-1 if g.doc_id is None else g.doc_id for g in got]
    assert order == sorted(order)
    assert shards.count() > (5 if shard_ids == 50 else 0)
    assert W.token_shards(frame(spark, [])).count() == 0


# --- mixture ---------------------------------------------------------------------------------

def targets_expected(sizes):
    """Share, cap, reshare the excess until none is above."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    left, out, free = 1.5 * sum(sizes.values()), {}, list(names)
    while free:
        lam = left / sum(weight[s] for s in free)
        above = [s for s in free if lam * weight[s] >= 2 * sizes[s]]
        if not above:
            out.update({s: lam * weight[s] for s in free})
            break
        for s in above:
            out[s] = 2.0 * sizes[s]
            left -= out[s]
            free.remove(s)
    return out


def test_sainte_lague_equals_highest_quotients(spark):
    r = random.Random(2)
    rows = [(g, i, r.choice([0.0, r.random() * 10, float(r.randint(1, 4))]), {0: 3, 1: 40, 2: 1000, 3: 0}[g]) for g in range(4) for i in range(12)]
    df = spark.createDataFrame(rows, "g int, i int, w double, seats long")
    got = {(x.g, x.i): x.out for x in M.sainte_lague(df, ["g"], "i", "w", "seats", "out").collect()}
    for g in range(4):
        own = [(w, i) for gg, i, w, _ in rows if gg == g]
        seats = {0: 3, 1: 40, 2: 1000, 3: 0}[g]
        quotients = sorted(((-w / (2 * k - 1), i) for w, i in own if w > 0 for k in range(1, seats + 1)))[:seats]
        want = defaultdict(int)
        for _, i in quotients:
            want[i] += 1
        assert {i: got[g, i] for _, i in own} == {i: want[i] for _, i in own}


def check_mix(rows, got):
    size = lambda t: len(WORD.findall(t or ""))
    totals = defaultdict(int)
    for r in rows:
        totals[r[3]] += size(r[1])
    want = targets_expected(dict(totals))
    assert sorted(((g.doc_id, g.size) for g in got), key=str) == sorted(((r[0], size(r[1])) for r in rows), key=str)
    taken = defaultdict(int)
    for g in got:
        assert g.source_size == totals[g.source] and g.target == pytest.approx(want[g.source])
        assert 0 <= g.taken <= 2 * g.size
        taken[g.source] += g.taken
    return taken, want


def test_mix_awkward_rows(spark):
    got = M.mix(frame(spark), block=4).collect()
    taken, want = check_mix(odd_rows(), got)
    for s, t in want.items():
        assert abs(taken[s] - t) <= 4 * (int(sum(want.values()) ** 0.5 / 32) + 3) + 0.01 * t, s
    again = M.mix(frame(spark).repartition(5), block=4).collect()
    key = lambda g: (str(g.doc_id), g.size, g.taken)
    assert sorted(map(key, again)) == sorted(map(key, got))
    assert M.mix(frame(spark, [])).count() == 0
    assert M.mixed_documents(frame(spark, [])).count() == 0


def taken_expected(spark, rows, block, seed=42):
    """Sorted (doc_id, size, taken), block by block; only the seeded hashes come from Spark."""
    from pyspark.sql import functions as F
    size = [len(WORD.findall(r[1] or "")) for r in rows]
    keyed = spark.createDataFrame([(i, r[0], r[1] or "") for i, r in enumerate(rows)], "i int, d long, t string").withColumn(
        "h", F.xxhash64(F.lit(seed), "d", "t"))
    hashes = {r.i: (r.h, r.o) for r in keyed.withColumn("o", F.xxhash64(F.lit(seed + 2), "h")).collect()}
    totals = defaultdict(int)
    for r, n in zip(rows, size):
        totals[r[3]] += n
    target = targets_expected(dict(totals))
    quota = {s: 2 * totals[s] if target[s] >= 2 * totals[s] else int(target[s] // block) * block for s in target}
    left = int(sum(target.values()) + 0.5) - sum(quota.values())
    for s in sorted(target, key=lambda s: (-target[s] / (2 * int(target[s] // block) + 1), list(target).index(s))):
        more = max(0, min(block, 2 * totals[s] - quota[s], left))
        quota[s], left = quota[s] + more, left - more
    names = sorted((s for s in totals if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in totals)
    parts = int(sum(totals.values()) ** 0.5 / 32) + 1
    shard_of = lambda i: hashes[i][0] % parts % (int(totals[rows[i][3]] ** 0.5 / 32) + 1)
    shards = defaultdict(list)
    for i, r in enumerate(rows):
        shards[r[3], shard_of(i)].append(i)
    words = {k: sum(size[i] for i in own) for k, own in shards.items()}
    ids = [(names.index(s), k, b) for (s, k), n in words.items() for b in range(-(-n // block))]
    order = {(r.s, r.k, r.b): r.x for r in spark.createDataFrame([(s + 1, k, b) for s, k, b in ids], "s int, k int, b long").withColumn(
        "x", F.xxhash64(F.lit(seed + 1), "s", "k", "b")).collect()} if ids else {}
    out = []
    for s in names:
        own, left, dealt = sorted(k for t, k in shards if t == s), quota[s], defaultdict(int)
        for _, k, j in sorted((-words[s, k] / (2 * j - 1), k, j) for k in own for j in range(1, -(-2 * words[s, k] // block) + 1)):
            n = min(block, 2 * words[s, k] - block * (j - 1), left)
            dealt[k], left = dealt[k] + n, left - n
        for k in own:
            n = words[s, k]
            whole, some = divmod(dealt[k], n) if n else (0, 0)
            length = lambda b: min(block, n - b * block)
            times = []
            for b in range(-(-n // block)):
                times += [whole] * length(b)
            for b in sorted(range(-(-n // block)), key=lambda b: (length(b) < block, order[names.index(s) + 1, k, b], b)):
                take = min(length(b), some)
                some -= take
                for w in range(b * block, b * block + take):
                    times[w] += 1
            at = 0
            for i in sorted(shards[s, k], key=lambda i: (hashes[i][1], rows[i][0] is not None, rows[i][0] or 0, size[i])):
                out.append((str(rows[i][0]), size[i], sum(times[at:at + size[i]])))
                at += size[i]
    return sorted(out)


@pytest.mark.parametrize("block", [4, 64])
def test_mix_equals_block_by_block_selection(spark, block):
    r = random.Random(11)
    hot = [(d, " ".join(f"w{r.randrange(99)}" for _ in range(r.randint(0, 60))), "en", "a", 1) for d in [77] * 150 + [None] * 150]
    for rows in (odd_rows(), odd_rows() + hot + [(500 + i, "x " * r.randint(1, 300), "en", r.choice("abc"), 1) for i in range(300)]):
        got = sorted((str(g.doc_id), g.size, g.taken) for g in M.mix(frame(spark, rows), block=block).collect())
        assert got == taken_expected(spark, rows, block)


def test_rows_of_one_id_or_of_none_spread_over_the_shards(spark):
    rows = [(d, f"row {i} " + "w " * 98, "en", "a", 1) for i, d in enumerate([5] * 1500 + [None] * 1500 + list(range(10, 1510)))]
    plan = M.Mix(frame(spark, rows)).placed
    sizes = {(k.doc_id, k.shard): k["count"] for k in plan.where("doc_id = 5 or doc_id is null").groupBy("doc_id", "shard").count().collect()}
    n = plan.select("shard").distinct().count()
    assert n > 10 and len(sizes) == 2 * n and max(sizes.values()) < 3 * 1500 / n


def test_small_source_meets_its_target_in_a_large_corpus(spark):
    from pyspark.sql import functions as F
    docs = spark.range(100).select(F.col("id").alias("doc_id"), F.repeat(F.lit("a "), 10).alias("text"), F.lit("a").alias("source"))
    docs = docs.union(spark.range(1000, 1400).select("id", F.repeat(F.lit("b "), 30_000), F.lit("b")))
    got = M.mix(docs).groupBy("source").agg(F.sum("taken").alias("taken"), F.max("target").alias("target")).collect()
    assert {r.source for r in got} == {"a", "b"}
    assert [r for r in got if abs(r.taken - r.target) >= 64] == []


def test_words_reach_shards_with_room(spark):
    r = random.Random(3)
    quotas = [lambda n: 2 * n, lambda n: 2 * n - 5, lambda n: n, lambda n: 7 * 4, lambda n: 0, lambda n: 2 * n]
    sizes = [[r.choice([0, 1, 2, 3, 5, 17, 400]) for _ in range(25)] for _ in quotas[:-1]] + [[0, 0]]
    rows = [(g, i, n, quotas[g](sum(sizes[g]))) for g in range(len(quotas)) for i, n in enumerate(sizes[g])]
    df = spark.createDataFrame(rows, "source_no int, shard int, shard_size long, quota long")
    got = {(x.source_no, x.shard): x.words for x in M.shard_words(df, 4, 2).collect()}
    for g, own in enumerate(sizes):
        left, want = quotas[g](sum(own)), defaultdict(int)
        for _, i, k in sorted((-n / (2 * k - 1), i, k) for i, n in enumerate(own) for k in range(1, -(-2 * n // 4) + 1)):
            words = min(4, 2 * own[i] - 4 * (k - 1), left)
            want[i] += words
            left -= words
        assert left == 0 and {i: got[g, i] for i in range(len(own))} == {i: want[i] for i in range(len(own))}, g


def test_many_small_sources_keep_to_a_block_of_their_targets(spark):
    rows = [(i, "w " * (12 + i % 9), "en", f"s{i:03}", 1) for i in range(150)] + [(1000 + i, "w " * 900, "en", "zz", 1) for i in range(20)]
    taken, want = check_mix(rows, M.mix(frame(spark, rows)).collect())
    assert all(abs(taken[s] - t) < 64 for s, t in want.items())
    assert abs(sum(taken.values()) - sum(want.values())) <= 0.5 and all(taken[s] == t for s, t in want.items() if s != "zz")


def test_mix_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text", "lang", "source", "n_chars").collect()]
    got = M.mix(docs).collect()
    taken, want = check_mix(rows, got)
    for s, t in want.items():
        assert abs(taken[s] - t) < 0.01 * t
    words = {g.doc_id: g.taken for g in got}
    mixed = M.mixed_documents(docs)
    assert mixed.columns == docs.columns
    out = defaultdict(int)
    text = {r[0]: WORD.findall(r[1] or "") for r in rows}
    for r in mixed.collect():
        own = WORD.findall(r.text)
        out[r.doc_id] += len(own)
        it = iter(text[r.doc_id])
        assert all(w in it for w in own)                            # a subsequence of the document's words
        assert r.n_chars == len(r.text)
    assert {d: n for d, n in words.items() if n} == dict(out)
