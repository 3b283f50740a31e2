"""Mixing against exact arithmetic; host quality rules against brute force."""

import random
import re
from collections import Counter, defaultdict

from llm_fixtures import make_docs, sf  # noqa: F401
from riskloom.llm import mixing as M
from riskloom.llm import quality_hosts as Q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(t):
    return WORD.findall(t or "")


def mix_docs():
    rnd = random.Random(3)
    rows = []
    for i in range(3000):
        s = rnd.choice(["a", "a", "a", "b", "c", "é", None, "tiny"]) if i % 40 else "tiny"
        if s == "tiny" and i % 40:
            s = "a"
        rows.append((i, " ".join("w" for _ in range(rnd.randint(0, 40))), "en", s))
    return rows + [(9000, None, "en", "a"), (9001, "", "en", "nothing"), (9002, None, "en", "nothing"),
                   (7, rows[7][1], "en", rows[7][3])]


def targets(sizes):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    w = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, full = sum(sizes.values()), set()
    while True:
        open_ = [s for s in names if s not in full]
        if not open_:
            break
        level = (total - sum(3 * sizes[s] for s in full)) / sum(w[s] for s in open_)
        more = {s for s in open_ if w[s] * level > 3 * sizes[s]}
        if not more:
            break
        full |= more
    return {s: 3.0 * sizes[s] if s in full else w[s] * level for s in names}


def test_mixing(spark, make_docs, sf):
    from riskloom.llm.queries import QUERIES
    rows = mix_docs()
    d = sf(documents=make_docs(rows))
    out = QUERIES["op9_mixing"](spark, d).collect()
    assert sorted(r["doc_id"] for r in out) == sorted(r[0] for r in rows)
    source = {r[0]: r[3] for r in rows}
    size = {r[0]: len(words(r[1])) for r in rows}
    total = Counter()
    for r in rows:
        total[r[3]] += size[r[0]]
    want = targets(total)
    taken = Counter()
    for r in out:
        s = source[r["doc_id"]]
        assert r["size"] == size[r["doc_id"]] and r["source_size"] == total[s]
        assert abs(r["target"] - want[s]) < 1e-6 * max(1, want[s])
        assert r["taken"] <= 3 * r["size"] and (r["size"] == 0 or r["taken"] % r["size"] == 0)
        taken[s] += r["taken"]
    for s in want:
        assert abs(taken[s] - want[s]) <= 80, (s, taken[s], want[s])
    key = lambda rs: sorted((r["doc_id"], r["taken"]) for r in rs)
    assert key(out) == key(QUERIES["op9_mixing"](spark, d).collect())


def test_thresholds_are_nested(spark, make_docs):
    df = make_docs(mix_docs())
    some = [Counter((r["doc_id"], r["text"]) for r in M.mix(df, share=s).collect()) for s in (0.3, 0.6, 1.0)]
    assert sum(some[0].values()) < sum(some[1].values()) < sum(some[2].values())
    assert not some[0] - some[1]


def test_mix_keeps_columns_and_empty(spark, make_docs):
    from pyspark.sql import functions as F
    df = make_docs(mix_docs()).withColumn("h", F.lit("x")).withColumn("copies", F.lit(None).cast("int"))
    out = M.mix(df)
    assert out.columns == df.columns and out.count() > 0
    assert M.mix(df.limit(0)).count() == 0
    assert M.mix(make_docs([(1, None), (2, " ")])).count() == 0


def test_equal_rows_at_the_boundary_are_taken_singly(spark, make_docs, sf):
    """A third of each source is one row many times over: the taken words still come within half a text of the target."""
    from riskloom.llm.queries import QUERIES
    rows = [(i, " ".join(["w"] * (1 + i % 9)), "en", ["a", "b", None][i % 3]) for i in range(600)]
    for k, s in enumerate(["a", "b", None]):
        rows += [(None if k else 7000, "w w w w", "en", s)] * 1500
    docs = make_docs(rows, 5)
    size = {s: sum(len(words(t)) for _, t, _, x in rows if x == s) for s in ("a", "b", None)}
    want = targets(size)
    out = M.mix(docs).collect()
    plan = QUERIES["op9_mixing"](spark, sf(documents=docs)).collect()
    assert len(plan) == len(rows)
    assert sum(r["taken"] for r in plan) == sum(len(words(r["text"])) for r in out)
    for s in size:
        assert abs(sum(len(words(r["text"])) for r in out if r["source"] == s) - want[s]) <= 4.5
    have = Counter((r["doc_id"], r["text"], r["source"]) for r in out)
    assert all(have[i, t, s] <= 3 * n for (i, t, s), n in Counter((i, t, s) for i, t, _, s in rows).items())


def measure(text):
    t = text or ""
    w = words(t)
    win = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    hit = {p for i in range(len(w) - 7) if win[tuple(w[i:i + 8])] > 1 for p in range(i, i + 8)}
    lines = [x for x in t.split("\n") if words(x)]
    return (len(w), sum(map(len, w)), sum(t.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(hit))


def quality_docs():
    rnd = random.Random(9)
    rows = [(0, None), (1, ""), (2, " \n\t "), (3, "é " * 30), (4, "a\r\nb\na\r\nb #|<\n\n x " * 9), (5, "x" * 5000)]
    for i in range(6, 400):
        n = rnd.choice([3, 19, 20, 60])
        t = " ".join(rnd.choice(["aa", "b$", "ç", "dd"]) + (str(rnd.randint(0, 99)) if rnd.random() < 0.8 else "") for _ in range(n))
        if rnd.random() < 0.2:
            t = "\n".join([t] * 3)
        rows.append((i, t))
    # one host of short texts only, one with nulls, one small
    return [(i, t if i % 10 or i < 6 else "too short", "en", "bad" if i % 10 == 0 and i > 5 else [None, "good", "fine"][i % 3]) for i, t in rows]


def test_quality(spark, make_docs, sf):
    from riskloom.llm.queries import QUERIES
    rows = quality_docs()
    out = {r["doc_id"]: r for r in QUERIES["op7_quality_hosts"](spark, sf(documents=make_docs(rows))).collect()}
    assert len(out) == len(rows)
    by = defaultdict(list)
    for i, t, _, s in rows:
        m = measure(t)
        r = out[i]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == m, i
        assert r["base_failed"] == (m[0] < 20 or 100 * m[4] > 30 * m[0])
        by[s].append(r["base_failed"])
    N, K = len(rows), len(by)
    f = sum(map(sum, by.values()))
    nn = sum(len(x) ** 2 for x in by.values())
    npp = sum(sum(x) ** 2 / len(x) for x in by.values())
    prior, m = Q.prior_rows(N, f, K, nn, npp)
    assert 0 < prior < 1e6
    for i, _, _, s in rows:
        rate = (sum(by[s]) + prior * m) / (len(by[s]) + prior)
        assert abs(out[i]["host_rate"] - rate) < 1e-9
        assert out[i]["kept"] == (not out[i]["base_failed"] and rate <= 0.5)
    assert Q.judge(make_docs(rows).limit(0), __import__("pyspark").sql.functions.col("source"), ["doc_id"]).count() == 0


def test_shrinkage_keeps_small_hosts_near_the_common_rate():
    prior, m = Q.prior_rows(1000, 100, 10, 10 * 100.0 ** 2, 10 * 100 * 0.1 ** 2)
    assert prior == 1e6 and abs(m - 0.1) < 1e-12  # no spread between hosts
    assert Q.prior_rows(0, 0, 0, 0.0, 0.0) == (1e6, 0.0)


def test_url_host(spark):
    df = spark.createDataFrame([("HTTP://u:p@Blog.Ex.com:80/a",), ("https://x.org#t",), ("nothing",), (None,)], "url string")
    from pyspark.sql import functions as F
    assert [r[0] for r in df.select(Q.url_host(F.col("url"))).collect()] == ["blog.ex.com", "x.org", "", None]
