"""Jaccard join and components against brute force, skewed groups and edge cases."""

import random
from collections import Counter

import numpy as np
import pytest

from llm_fixtures import make_docs, sf  # noqa: F401
from riskloom.llm import jaccard_join as J
from riskloom.llm.components import components


def shingle_set(text, n=5):
    w = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    k = min(n, len(w))
    return frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if w else frozenset()


def smallest(nodes, links):
    par = {n: n for n in nodes}

    def find(x):
        while par[x] != x:
            par[x] = par[par[x]]
            x = par[x]
        return x
    for a, b in links:
        a, b = find(a), find(b)
        par[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def brute(rows):
    """{doc_id: (n_shingles, component_id)} by all pairs."""
    s = {i: shingle_set(t) for i, t in rows}
    ids = sorted(s)
    links = []
    for x, a in enumerate(ids):
        for b in ids[x + 1:]:
            both = len(s[a] & s[b])
            if both and 100 * both >= 80 * (len(s[a]) + len(s[b]) - both):
                links.append((a, b))
    comp = smallest(ids, links)
    return {i: (len(s[i]), comp[i]) for i in ids}


def text_rows(seed=0, n=140):
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(4))
    passage = [word() for _ in range(80)]
    rows = [(0, None), (1, ""), (2, " \n "), (3, "one"), (4, "One"), (5, "one two"), (6, "a b c d"), (7, "A B C D"), (8, "a b c d e")]
    while len(rows) < n:
        kind = rnd.random()
        if kind < 0.3 or len(rows) < 15:
            t = [word() for _ in range(rnd.choice([4, 5, 6, 10, 30, 150]))]
        elif kind < 0.7:  # a near copy: a few words changed, at the edge of the similarity
            t = (rnd.choice(rows)[1] or "").split() or ["x"]
            for _ in range(rnd.randint(0, max(1, len(t) // 25))):
                t[rnd.randrange(len(t))] = word()
            t = t[rnd.randint(0, 2):]
        elif kind < 0.9:  # a passage that many share, with more or less of their own
            t = passage + [word() for _ in range(rnd.choice([0, 3, 10, 20, 25, 60]))]
        else:
            t = (rnd.choice(rows)[1] or "y").split()
        rows.append((len(rows), " ".join(t)))
    return rows


@pytest.mark.parametrize("frequent", [1, 2, 9])
def test_brute_force(spark, make_docs, sf, monkeypatch, frequent):
    """With 1 all indexed shingles of the texts looked at go by pairs of a class, with 9 nearly all by themselves."""
    from riskloom.llm.queries import QUERIES
    monkeypatch.setattr(J, "FREQUENT", frequent)
    rows = text_rows(frequent)
    out = QUERIES["op8_jaccard_join"](spark, sf(documents=make_docs(rows)))
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in out.collect()} == brute(rows)


def test_labels_come_from_all_texts(spark, make_docs):
    """A passage in FREQUENT texts is labelled, one in a text less is not, wherever these texts lie."""
    own = iter(range(10 ** 9))
    text = lambda passage: " ".join([*(f"o{next(own)}" for _ in range(5)), *passage])
    passages = {(i, n): [f"p{i}_{n}_{j}" for j in range(5)] for i in range(10) for n in (J.FREQUENT, J.FREQUENT - 1)}
    rows = [text(p) for (i, n), p in passages.items() for _ in range(n)]
    bitmap = J.frequent_bitmap(make_docs(list(enumerate(rows)), 5), J.WORDS)
    for (i, n), p in passages.items():
        assert J.marked(J.shingles(" ".join(p).encode()), bitmap).tolist() == [n == J.FREQUENT]
    assert int(np.bitwise_count(bitmap).sum()) == 10


def test_signatures_lose_no_link():
    """Any two linked sets share an index key, whatever is labelled frequent."""
    rng = np.random.default_rng(1)
    for trial in range(400):
        n = int(rng.integers(2, 120))
        a = np.unique(rng.integers(0, 1 << 62, n).astype(np.uint64))
        lose = int(rng.integers(0, max(1, n // 4) + 1))
        b = np.unique(np.concatenate([a[rng.permutation(len(a))[lose:]],
                                      rng.integers(0, 1 << 62, int(rng.integers(0, max(1, n // 6) + 1))).astype(np.uint64)]))
        both = len(np.intersect1d(a, b))
        if 100 * both < 80 * (len(a) + len(b) - both) or np.array_equal(a, b):
            continue
        pool = np.union1d(a, b)
        frequent = np.sort(pool[rng.random(len(pool)) < rng.choice([0, 0.5, 0.9, 1.0])])
        assert len(np.intersect1d(J.signatures(a, np.isin(a, frequent)), J.signatures(b, np.isin(b, frequent)))), (n, lose)


def test_overlap_counts_repeats():
    rng = np.random.default_rng(3)
    for _ in range(50):
        x, y = np.sort(rng.integers(0, 30, 40)), np.sort(rng.integers(0, 30, 25))
        assert J.overlap(x, y) == sum((Counter(x.tolist()) & Counter(y.tolist())).values())


def test_block_links():
    """The matrix product equals plain intersections, over several slices."""
    rng = np.random.default_rng(4)
    pool = rng.integers(0, 1 << 62, 6000).astype(np.uint64)
    base = rng.permutation(pool)[:3000]
    sets = [np.unique(np.concatenate([base[rng.random(3000) < 0.93], rng.permutation(pool)[:n]])) for n in [0, 5, 300, 900] * 5]
    got = J.block_links(sets[:9], sets[9:], 80)
    for i, x in enumerate(sets[:9]):
        for j, y in enumerate(sets[9:]):
            both = len(np.intersect1d(x, y))
            assert got[i, j] == (100 * both >= 80 * (len(x) + len(y) - both))


def test_pairs_equal_blocks():
    rng = np.random.default_rng(5)
    base = np.arange(400, dtype=np.uint64)
    data = [np.unique(base[rng.random(400) < keep]) for keep in (0.99, 0.95, 0.9, 0.6, 0.3)] + [base[:1], base]
    want = J.block_links(data, data, 80)
    us, vs = J.pair_links(data, J.combinations(range(len(data)), 2), 80)
    assert set(zip(us.tolist(), vs.tolist())) == {(i, j) for i in range(7) for j in range(i + 1, 7) if want[i, j]}
    assert len(us) and not len(J.pair_links(data, [], 80)[0])


def test_shingles_of_many_texts(monkeypatch):
    """Texts hashed together have the sets they have alone; words end at ASCII spaces and A-Z are lowered."""
    texts = [None, "", " \t\n", "One", "one", "a b c d e", " A  b\nc\td e\x0b", "a b c d e f", "\u00a0x \u00c9", "a b c d"] * 3
    raw = [t if t is None else t.encode() for t in texts]
    for together in (1, 7, 1 << 17):
        monkeypatch.setattr(J, "TOGETHER", together)
        got = [s.tolist() for s in J.shingle_sets(raw)]
        assert got == [J.shingles(t).tolist() for t in raw]
    assert [len(s) for s in got[:10]] == [0, 0, 0, 1, 1, 1, 1, 2, 1, 1]
    assert got[3] == got[4] and got[5] == got[6] and got[5][0] in got[7] and got[9] != got[5]


def test_blocks_lose_no_link(spark, make_docs, monkeypatch):
    """Blocks of ten sets: copies of one text, many of them below the similarity, linked only through others."""
    monkeypatch.setattr(J, "BLOCK_SETS", 10)
    rnd = random.Random(9)
    base = [f"b{i}" for i in range(100)]
    rows = []
    for i in range(45):
        t = list(base)
        for _ in range(rnd.randint(0, 5)):
            t[rnd.randrange(100)] = f"n{rnd.randint(0, 60)}"
        rows.append((i, " ".join(t)))
    out = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in J.jaccard_components(make_docs(rows, 5)).collect()}
    assert out == brute(rows)
    assert len({c for _, c in out.values()}) > 3


def test_repeated_rows_and_ids(spark, make_docs):
    t = " ".join(f"w{i}" for i in range(40))
    rows = [(5, t), (5, t), (9, t + " x"), (5, "quite another text of seven words here"), (None, t), (None, None), (2, "")]
    out = sorted(((r["doc_id"] or -1), r["n_shingles"], r["component_id"]) for r in J.jaccard_components(make_docs(rows)).collect())
    assert out == sorted([(5, 36, 5), (5, 36, 5), (9, 37, 5), (5, 3, 5), (-1, 36, 5), (-1, 0, None), (2, 0, 2)], key=lambda x: x[:2])
    assert J.jaccard_components(make_docs(rows).limit(0)).count() == 0


def test_large_group_of_near_copies(spark, make_docs):
    """A third of all rows near copies of one text, another group of exact copies."""
    rnd = random.Random(8)
    base = [f"b{rnd.randint(0, 999)}" for _ in range(120)]
    rows = []
    for i in range(400):
        t = list(base)
        t[rnd.randrange(120)] = f"new{i}"
        rows.append((i, " ".join(t)))
    rows += [(1000 + i, "the same text for all of these copies again") for i in range(300)]
    rows += [(2000 + i, " ".join(f"u{i}_{j}" for j in range(30))) for i in range(200)]
    out = {r["doc_id"]: r["component_id"] for r in J.jaccard_components(make_docs(rows, 7)).collect()}
    assert {out[i] for i in range(400)} == {0} and {out[1000 + i] for i in range(300)} == {1000}
    assert all(out[2000 + i] == 2000 + i for i in range(200))


def test_keep_one(spark, make_docs):
    from pyspark.sql import functions as F
    rows = text_rows(3, 80)
    df = make_docs(rows + [rows[20], rows[20]]).withColumn("key", F.lit(1)).withColumn("rows", F.lit("x"))
    out = J.keep_one(df)
    assert out.columns == df.columns
    kept = Counter(r["doc_id"] for r in out.collect())
    comp = brute(rows)
    want = {c for n, c in comp.values()}
    text = dict(rows)
    assert set(kept) == want
    assert all(v == 1 or not (text[k] or "").split() for k, v in kept.items())  # empty texts all stay


def test_components_of_chains_and_stars(spark):
    rnd = random.Random(1)
    links = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + i) for i in range(1, 50)] + [(200, 200), (301, 300), (300, 301)]
    links += [(rnd.randint(400, 460), rnd.randint(400, 460)) for _ in range(40)]
    df = spark.createDataFrame([(f"{a:04d}", f"{b:04d}") for a, b in links], "u string, v string").repartition(4)
    got = {int(r["node"]): int(r["root"]) for r in components(df).collect()}
    nodes = {x for a, b in links for x in (a, b) if a != b}
    assert got == smallest(nodes, [(a, b) for a, b in links if a != b])
    assert components(df.limit(0)).count() == 0


def test_oracle_sql(spark):
    from compare import compare, duck
    from conftest import SF_SMALL
    from riskloom.llm import oracle
    from riskloom.llm.queries import QUERIES
    con = duck(SF_SMALL)
    for name, sql in oracle.queries().items():
        ok, msg = compare(QUERIES[name](spark, SF_SMALL), con, sql)
        assert ok, (name, msg)
