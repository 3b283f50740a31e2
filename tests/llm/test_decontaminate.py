"""Decontamination against brute force, edge cases and slices."""

import hashlib
import random
import re

from llm_fixtures import make_docs, sf  # noqa: F401
from riskloom.llm import decontaminate as D

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def norm(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, n=10):
    wins = []
    for item, text in items:
        w = norm(text)
        if w:
            k = min(n, len(w))
            wins += [(item, w[i:i + k]) for i in range(len(w) - k + 1)]
    out = {}
    for doc, text in docs:
        w, hit, ids = norm(text), set(), set()
        for item, win in wins:
            for i in range(len(w) - len(win) + 1):
                if w[i:i + len(win)] == win:
                    hit.update(range(i, i + len(win)))
                    if item is not None:
                        ids.add(str(item))
        sha = hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()
        out[doc] = (len(w), len(hit), len(ids), sha, bool(hit))
    return out


def cases():
    rnd = random.Random(5)
    vocab = ["Ab", "cé", "d9", "e", "F", "ß", "x'y"]
    text = lambda n: " ".join(rnd.choice(vocab) for _ in range(n))
    items = [(i, text(rnd.choice([3, 9, 10, 11, 25]))) for i in range(8)] + [(90, None), (91, ""), (92, "..."), (None, text(12)), (3, text(10))]
    docs = [(i, text(rnd.randint(0, 30)) + rnd.choice(["", ". ", "\n"]) + (rnd.choice(items)[1] or "") + " tail") for i in range(40)]
    return docs + [(100, None), (101, ""), (102, "--"), (103, (items[3][1] + " z ") * 200)], items


def got(df):
    return {r["doc_id"]: (r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) for r in df.collect()}


def test_brute_force_one_slice_and_many(spark, make_docs):
    docs, items = cases()
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    want = brute(docs, items)
    total = sum(len(f"{i or ''}{t or ''}".encode()) for i, t in items)
    for slice_bytes, maps in ((1 << 20, 1), (total * 2 // 3, 4), (120, 1)):
        out = D.scan(make_docs(docs), bench, ["doc_id"], slice_bytes=slice_bytes)
        assert got(D.digest(out)) == want
        assert arrow_maps(out) == maps


def arrow_maps(df):
    return df._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow")


def test_benchmark_beyond_the_broadcast(spark, make_docs):
    """A third of the items equal, another third one text under many ids: joined, in one Arrow map, whatever the filter's size."""
    docs, items = cases()
    docs += [(200 + i, docs[0][1]) for i in range(40)]
    items += [(items[0][0], items[0][1])] * 60 + [(1000 + i, items[1][1]) for i in range(60)]
    bench = spark.createDataFrame(items, "item_id bigint, text string").repartition(5)
    want = brute(docs, sorted(set(items), key=str))
    df = make_docs(docs)
    out = D.scan(df, bench, ["doc_id"], slice_bytes=200)
    assert arrow_maps(out) == 1
    assert got(D.digest(out)) == want
    few = bench.select(bench.item_id.cast("string").alias("item_id"), "text").distinct()
    for bits in (1 << 3, 1 << 15, 1 << 20):
        assert got(D.digest(D.scan_by_join(df, few, ["doc_id"], filter_bits=bits))) == want
    clean = {k for k, v in want.items() if not v[4]}
    assert {r["doc_id"] for r in D.decontaminate(df, bench, slice_bytes=200).collect()} == clean
    none = D.scan_by_join(df, few.limit(0), ["doc_id"])
    assert all(not r["hit_words"] and not r["items"] for r in none.collect())
    assert D.scan_by_join(df.limit(0), few, ["doc_id"]).count() == 0


def test_query_and_empty_tables(spark, make_docs, sf):
    from riskloom.llm.queries import QUERIES
    docs, items = cases()
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    d = sf(documents=make_docs(docs), benchmark=bench)
    assert got(QUERIES["op3_decontaminate"](spark, d)) == brute(docs, items)
    d = sf(documents=make_docs(docs), benchmark=bench.limit(0))
    assert all(v[1:3] == (0, 0) for v in got(QUERIES["op3_decontaminate"](spark, d)).values())
    d = sf(documents=make_docs(docs).limit(0), benchmark=bench)
    assert QUERIES["op3_decontaminate"](spark, d).count() == 0


def test_filter_keeps_columns_and_rows(spark, make_docs):
    docs, items = cases()
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    df = make_docs(docs + [docs[0]]).withColumn("n_hit", __import__("pyspark").sql.functions.lit("x"))
    clean = {k for k, v in brute(docs, items).items() if not v[4]}
    out = D.decontaminate(df, bench)
    assert out.columns == df.columns
    assert {r["doc_id"] for r in out.collect()} == clean
    cut = {r["doc_id"]: r["text"] for r in D.decontaminate(df, bench, mode="span").collect()}
    assert set(cut) == {k for k, _ in docs}
    for k, t in docs:
        hit = brute([(k, t)], items)[k]
        assert len(norm(cut[k])) >= hit[0] - hit[1] - 1 and (hit[4] or cut[k] == t)
