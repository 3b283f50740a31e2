"""Line dedup against brute force, its reversal by deletions, and the cuckoo filter itself."""

import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from compare import compare, duck
from conftest import SF_SMALL
from llm_fixtures import make_docs, sf  # noqa: F401
from riskloom.llm import line_dedup as L
from riskloom.llm.oracle import queries as oracle


def key(line):
    k = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(" \t\n\r\x0b\x0c"))
    return k if len(k) >= 10 else None


def brute(rows, index_rows=None):
    own = defaultdict(set)
    for i, t in (index_rows or rows):
        for x in (t or "").split("\n"):
            if key(x):
                own[key(x)].add(i)
    first = {k: min(v, key=lambda i: (i is None, i)) for k, v in own.items() if len(v) > 1}
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        stay = [x for x in lines if key(x) not in first or first[key(x)] == i]
        out.append((i, len(lines), len(lines) - len(stay), hashlib.sha256("\n".join(stay).encode()).hexdigest()))
    return sorted(out, key=str)


def digest(df):
    df = df.withColumn("h", F.sha2(F.col("kept").cast("binary"), 256))
    return sorted(((r[0], r["n_lines"], r["n_dropped"], r["h"]) for r in df.collect()), key=str)


def rows_of(seed, n=80):
    rnd = random.Random(seed)
    pool = [f"shared line number {i} é" for i in range(12)] + ["short", "", "  PADDED line here \t", "padded LINE here", "ÉÉÉÉÉÉÉÉÉ", "ééééééééé!"]
    out = [(0, None), (1, ""), (2, "\n\n"), (3, "the very common line\nx"), (3, "the very common line\nother text of three"), (None, "the very common line"), (None, "null line alone")]
    for i in range(10, n):
        lines = [rnd.choice(pool) for _ in range(rnd.randint(0, 6))] + [f"own line of {i}"] * rnd.randint(0, 2)
        if i % 3 == 0:
            lines.append("the very common line")
        rnd.shuffle(lines)
        out.append((i, "\n".join(lines)))
    out += [out[-1], (n, "\n".join(f"Line {j % 40} of a long text" for j in range(9000)))]
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_brute_force(spark, make_docs, seed):
    rows = rows_of(seed)
    docs = make_docs(rows)
    index = L.LineIndex(spark).insert(docs)
    assert digest(index.keep(docs)) == brute(rows)
    index.close()


def test_insertions_and_deletions(spark, make_docs):
    rows = [r for r in rows_of(3) if r[0] is not None]
    part = lambda f: make_docs([r for r in rows if f(r[0])])
    index = L.LineIndex(spark, shard_keys=20).insert(part(lambda i: i % 2))
    odd = sorted(map(tuple, index.counts.collect()))
    index.insert(part(lambda i: i % 2 == 0)).insert(part(lambda i: i % 5 == 0))   # the last ones are all known
    assert digest(index.keep(make_docs(rows))) == brute(rows)
    fresh = L.LineIndex(spark, shard_keys=20).insert(make_docs(rows))
    assert sorted(map(tuple, index.counts.collect())) == sorted(map(tuple, fresh.counts.collect()))
    # deleting what came second brings the first state back: counts, first documents and filters
    index.delete(part(lambda i: i % 2 == 0).select("doc_id"))
    assert sorted(map(tuple, index.counts.collect())) == odd
    left = [r for r in rows if r[0] % 2]
    assert digest(index.keep(make_docs(left))) == brute(left)
    for row in index.filters.collect():
        f = L.CuckooFilter.load(row["data"])
        own = [r for r in odd if r[0] % index.shards == row["shard"]]
        assert f.held == len(own)
        assert f.contains(np.array([r[0] for r in own], np.int64), np.array([r[1] for r in own], np.int64)).all()
    index.delete(make_docs(rows).select("doc_id"))
    assert index.counts.count() == 0 and index.holders.count() == 0
    index.insert(make_docs(rows))
    assert digest(index.keep(make_docs(rows))) == brute(rows)


def test_cuckoo_filter():
    rng = np.random.default_rng(5)
    k = rng.integers(-2**63, 2**63 - 1, (30_000, 2))
    f = L.CuckooFilter.sized(20_000)
    f.insert(k[:12_000, 0], k[:12_000, 1])
    assert f.fits(8_000)
    f.insert(k[12_000:20_000, 0], k[12_000:20_000, 1])
    assert f.held == 20_000 and f.contains(k[:20_000, 0], k[:20_000, 1]).all()
    assert f.contains(k[20_000:, 0], k[20_000:, 1]).mean() < 0.001
    f.delete(k[:10_000, 0], k[:10_000, 1])
    assert f.held == 10_000 and f.contains(k[10_000:20_000, 0], k[10_000:20_000, 1]).all()
    assert f.contains(k[:10_000, 0], k[:10_000, 1]).mean() < 0.001
    again = L.CuckooFilter.load(f.dump())
    assert (again.table == f.table).all()


def test_empty_table_and_clashing_columns(spark, make_docs, sf):  # noqa: F811
    docs = make_docs([])
    assert digest(L.LineIndex(spark).insert(docs).keep(docs)) == []
    d = sf(documents=make_docs(rows_of(4)).withColumn("k1", F.lit("x")).withColumn("row", F.lit(None).cast("int"))
           .withColumn("kept", F.lit(1)).withColumn("shard", F.lit(2)).withColumn("doc", F.lit(3)).withColumn("_k1", F.lit(1)))
    got = sorted((tuple(r) for r in L.op11_line_dedup(spark, d).collect()), key=str)
    assert got == brute(rows_of(4))


def test_sql(spark):
    ok, msg = compare(L.op11_line_dedup(spark, SF_SMALL), duck(SF_SMALL), oracle()["op11_line_dedup"])
    assert ok, msg
