"""Registered queries, pipeline stages and independence of the rest of the library."""

import os
import re
import subprocess
import sys
from collections import Counter, defaultdict

import duckdb
import pyarrow as pa
import pytest

import __spark_entry__ as entry
import corpus_pipeline as C
from tidewater.llm import simhash

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
SF001, SF01 = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


def test_one_query_for_each_operator():
    names = [k for k in entry.queries() if re.match(r"op\d+_", k)]
    assert Counter(int(re.match(r"op(\d+)_", k)[1]) for k in names) == {i: 1 for i in range(1, 14)}
    assert "pipeline" in entry.queries() and set(entry.oracle_sql()) <= set(entry.queries())


def test_nothing_else_imports_the_subpackage():
    for folder, _, files in os.walk(os.path.join(ROOT, "tidewater")):
        if "llm" not in folder:
            for f in files:
                if f.endswith(".py"):
                    assert "llm" not in open(os.path.join(folder, f)).read(), f


def test_entry_works_without_the_subpackage():
    code = ("import sys\nclass Block:\n    def find_spec(self, name, *a):\n        if name.startswith('tidewater.llm'):\n"
            "            raise ModuleNotFoundError(name)\nsys.meta_path.insert(0, Block())\nimport __spark_entry__ as e\n"
            "assert not any(k.startswith('op') and k[2].isdigit() for k in e.queries()) and 'pipeline' not in e.queries()\n")
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True, timeout=120)


@pytest.mark.parametrize("name", ["op1_embedding_near_dedup", "op6_exact_dedup", "op12_hard_negatives"])
def test_queries_equal_their_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF01}/{t}.parquet'")
    rel = con.sql(entry.oracle_sql()[name])
    cols = list(rel.columns)
    want = sorted(map(str, rel.fetchall()))
    got = sorted(str(tuple(r)) for r in entry.queries()[name](spark, SF01).select(*cols).collect())
    assert got == want


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    columns, seen = docs.columns, [docs]
    for _, stage in C.STAGES[:-1]:
        seen.append(C.save(stage(spark, seen[-1], SF001), "test-stage"))
        assert seen[-1].columns == columns
    rows = [[tuple(r) for r in df.collect()] for df in seen]
    first = {r[0]: r for r in rows[0]}
    for part in rows[1:4]:                                          # the first three stages only drop rows
        assert all(first[r[0]] == r for r in part) and len({r[0] for r in part}) == len(part)
    last = {}
    for r in rows[1]:
        last[r[1]] = max(last.get(r[1], -1), r[0])
    assert sorted(r[0] for r in rows[2]) == sorted(last.values())
    fps = {r[0]: int(x) & (2**64 - 1) for r, x in zip(rows[2], simhash.fingerprints_of(pa.array([r[1] for r in rows[2]])))}
    ids, root = sorted(fps), {}

    def find(i):
        while root.setdefault(i, i) != i:
            i = root[i]
        return i
    for n, i in enumerate(ids):
        for j in ids[:n]:
            if bin(fps[i] ^ fps[j]).count("1") <= 2:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    assert sorted(r[0] for r in rows[3]) == sorted({find(i) for i in ids})
    words = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t))
    total = sum(words(r[1]) for r in rows[4])
    assert abs(total / sum(words(r[1]) for r in rows[3]) - 1.5) < 0.03
    packed = C.STAGES[-1][1](spark, seen[-1], SF001).collect()
    assert Counter(p.doc_id for p in packed if p.piece == 0) == Counter(r[0] for r in rows[4])
    held = defaultdict(int)
    for p in packed:
        held[p.sequence_id] += p.length
    assert max(held.values()) <= 2048
    run = C.run(spark, SF001)
    key = lambda p: (p.doc_id, p.piece, p.start, p.length, p.ids_crc32)
    assert sorted(map(key, run.collect())) == sorted(map(key, packed))
