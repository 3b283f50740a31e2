"""Hard negatives against brute force in whole numbers, and what the bounds spare."""

import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from compare import compare, duck
from conftest import SF_SMALL
from llm_fixtures import sf  # noqa: F401
from riskloom.llm import hard_negatives as H
from riskloom.llm.oracle import queries as oracle

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def brute(rows):
    own = {}
    for i, v, c in rows:
        if i is None or v is None or c is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        own[(i, (c + 1) % 10 if i % 7 == 0 else c, tuple(math.floor(256 * float(np.float32(x))) for x in v))] = 1
    own, out = list(own), []
    for a, ca, va in own:
        if a % 50:
            continue
        score = lambda v: sum(x * y for x, y in zip(va, v))
        best = sorted((-score(v), i) for i, c, v in own if c == ca and i != a)[:5]
        other = sorted((-score(v), i) for i, c, v in own if c != ca)
        for p, i in best:
            fit = [(s, j) for s, j in other if 50 * -p <= 100 * -s <= 95 * -p][:3]
            out += [(a, i, k + 1, j, -p, -s) for k, (s, j) in enumerate(fit)]
    return sorted(out)


def rows_of(seed, n=420, big=1.0):
    rnd = random.Random(seed)
    centres = [[rnd.uniform(-1, 1) for _ in range(8)] for _ in range(5)]
    rows = []
    for i in range(n):
        c = rnd.choice(centres)
        rows.append((i, [big * (x + rnd.gauss(0, 0.2)) for x in c], rnd.randint(0, 4)))
    rows += [rows[0], rows[50], (50, [0.5] * 8, 1), (n, None, 1), (n + 1, [1.0] * 8, None), (n + 2, [None] + [1.0] * 7, 1),
             (n + 3, [float("nan")] * 8, 1), (n + 4, [float("inf")] + [0.0] * 7, 1), (n + 5, [], 2), (n + 6, [1.0, 0.5], 3), (None, [1.0] * 8, 1)]
    hot = [0.9] * 8
    rows += [(n + 10 + i, hot, i % 3) for i in range(n // 3)]          # one vector of a third of the rows: ties
    rnd.shuffle(rows)
    return rows


def run(spark, sf, rows, **kw):
    d = sf(embeddings=spark.createDataFrame(rows, SCHEMA).repartition(3).withColumn("score", F.lit(1)).withColumn("grp", F.lit("x")))
    if not kw:
        return sorted(tuple(r) for r in H.op12_hard_negatives(spark, d).collect())
    t = spark.read.parquet(f"{d}/embeddings.parquet")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = H.usable(t.select("vec_id", "embedding", moved.alias("label")))
    return sorted(tuple(r) for r in H.mine(rows, F.col("id") % 50 == 0, **kw).collect())


@pytest.mark.parametrize("seed", [1, 2])
def test_brute_force(spark, sf, seed):  # noqa: F811
    rows = rows_of(seed)
    assert run(spark, sf, rows) == brute(rows)


def test_many_blocks(spark, sf):  # noqa: F811
    rows = rows_of(3)
    assert run(spark, sf, rows, row_block=60, anchor_block=4) == brute(rows)


def test_scores_beyond_doubles(spark, sf):  # noqa: F811
    rows = rows_of(4, 150, big=3e5)
    assert run(spark, sf, rows) == brute(rows)


def test_empty(spark, sf):  # noqa: F811
    assert run(spark, sf, []) == []
    assert run(spark, sf, [(1, [1.0], 1), (2, [1.0], 1)]) == []          # no anchors
    assert run(spark, sf, [(50, [1.0], 1)]) == []                       # no other rows


def test_tree_and_bounds():
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(12, 16)) * 200
    x = np.floor(centres[rng.integers(0, 12, 3000)] + rng.normal(size=(3000, 16)) * 5)
    a = x[:200]
    parent, edge, order = H.spanning_tree(a)
    assert sorted(order) == list(range(200)) and parent[0] == -1
    place = {v: i for i, v in enumerate(order)}
    assert all(place[int(parent[i])] < place[i] for i in range(1, 200))
    # least total: equal to Kruskal's
    d = np.sqrt(((a[:, None] - a[None]) ** 2).sum(-1))
    root, total = list(range(200)), 0.0

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i, j in sorted(((i, j) for i in range(200) for j in range(i)), key=lambda e: d[e]):
        if find(i) != find(j):
            root[find(i)] = find(j)
            total += d[i, j]
    assert abs(edge.sum() - total) < 1e-6
    # bounds hold for every row, and few rows are scored again when anchors lie close
    s = H.Scorer(x, a[order])
    walk = np.argsort(order)
    for i, node in enumerate(order):
        up = -1 if parent[node] < 0 else int(walk[parent[node]])
        lo, hi = s.reach(i, up, float(edge[node]))
        true = x @ a[node]
        assert (lo <= true).all() and (true <= hi).all()
        s.settle(i, lo, hi, np.flatnonzero(hi >= np.partition(lo, -5)[-5]), True)
    assert s.rescored < 0.5 * 200 * 3000


def test_matrix_pads():
    m = H.matrix(pa.chunked_array([pa.array([[1.0, 2.0], [], [3.0]], pa.list_(pa.float64()))]))
    assert m.tolist() == [[1, 2], [0, 0], [3, 0]]


def test_sql(spark):
    ok, msg = compare(H.op12_hard_negatives(spark, SF_SMALL), duck(SF_SMALL), oracle()["op12_hard_negatives"])
    assert ok, msg
