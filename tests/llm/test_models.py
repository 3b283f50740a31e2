"""Language and toxicity models: held-out accuracy, restoration, edge cases."""

import itertools
import math

import numpy as np
import pytest

from conftest import SF_MID
from llm_fixtures import make_docs, sf  # noqa: F401
from riskloom.llm import langid as G
from riskloom.llm import toxicity as T
from riskloom.llm.queries import QUERIES


def test_language_accuracy(spark):
    got = QUERIES["op4_langid"](spark, SF_MID)
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet").select("doc_id", "lang")
    rows = got.join(docs, "doc_id").filter("held_out").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in rows) >= 0.97 * len(rows)
    assert got.count() == docs.count()
    assert sum(r["rejected"] for r in got.collect()) <= 0.02 * got.count()


def test_language_edges(spark, make_docs, sf):
    en = "the house of the river and that people with their words " * 3
    fr = "la maison du fleuve et ces gens avec leurs mots pour nous " * 3
    rows = [(i, en if i % 2 else fr, "en" if i % 2 else "fr") for i in range(60)]
    rows += [(100, None, "en"), (101, "", "fr"), (102, "123 !?", None), (103, en * 400, None), (104, "ß", None), (100, fr, None)]
    out = QUERIES["op4_langid"](spark, sf(documents=make_docs(rows))).collect()
    by = {(r["doc_id"], r["lang_pred"]): r for r in out}
    assert len(out) == len(rows)
    for i in (100, 101, 102):
        assert by[i, "und"]["score"] == 0.0 and by[i, "und"]["rejected"]
    assert (103, "en") in by and (100, "fr") in by
    assert all(by[i, "en" if i % 2 else "fr"]["score"] > 0.5 for i in range(60))
    assert all(0 <= r["score"] <= 1 for r in out)
    # lang is never an input of a prediction
    blank = [(i, t, None if __import__("zlib").crc32(str(i).encode()) % 3 == 1 else x) for i, t, x in rows]
    again = QUERIES["op4_langid"](spark, sf(documents=make_docs(blank))).collect()
    assert sorted((r["doc_id"], r["lang_pred"], r["score"]) for r in again) == sorted((r["doc_id"], r["lang_pred"], r["score"]) for r in out)
    none = make_docs([(1, en, None), (2, None, None)])
    assert {r["lang_pred"] for r in QUERIES["op4_langid"](spark, sf(documents=none)).collect()} == {"und"}
    assert QUERIES["op4_langid"](spark, sf(documents=none.limit(0))).count() == 0


def test_language_filter(spark, make_docs):
    from pyspark.sql import functions as F
    rows = [(i, "the house of the river " * 5, "en") for i in range(30)] + [(50, "la maison du fleuve " * 5, "fr")] * 30 + [(60, None)]
    df = make_docs(rows).withColumn("score", F.lit("x")).withColumn("t", F.lit(2))
    out = G.accepted(df, G.fit(df))
    assert out.columns == df.columns and out.count() == 60


def test_sample_of_a_language_of_copies(spark, make_docs):
    """Few different texts, each many times over: all of them are in the dictionary."""
    texts = [f"maison {chr(97 + k)}x fleuve" for k in range(20)]
    rows = [(i, texts[i % 20], "fr") for i in range(8000)] + [(9000 + i, "the house of the river", "en") for i in range(300)]
    dicts = dict(G.dictionaries(make_docs(rows)))
    assert set(dicts) == {"en", "fr"}
    assert all(x.encode() in dicts["fr"] for x in texts)


def test_narrow_margins_are_rejected(spark):
    """A language that was never learned and texts of two halves, against clean texts, whole and short."""
    rows = [r for r in spark.read.parquet(f"{SF_MID}/documents.parquet").select("doc_id", "text", "lang").collect()
            if r["text"] and r["lang"]]
    rows.sort(key=lambda r: r["doc_id"])
    left_out = min({r["lang"] for r in rows}, key=lambda x: (sum(r["lang"] == x for r in rows), x))
    known = [r for r in rows if r["lang"] != left_out]
    train = spark.createDataFrame([r for r in known if r["doc_id"] % 2], "doc_id bigint, text string, lang string")
    judge = G.Compressors(G.dictionaries(train)).judge
    fresh = [r for r in known if r["doc_id"] % 2 == 0]

    def rejected(texts):
        return sum(judge(G.letters(t))[2] < G.MIN_MARGIN for t in texts) / len(texts)
    halves = []
    langs = sorted({r["lang"] for r in fresh})
    for a, b in itertools.combinations(langs, 2):
        for x, y in zip(*([r["text"] for r in fresh if r["lang"] == k] for k in (a, b))):
            k = min(len(x), len(y), 1000)
            halves.append(x[:k] + " " + y[:k])
    got = [rejected(x) for x in ([r["text"] for r in rows if r["lang"] == left_out], halves,
                                 [r["text"] for r in fresh], [r["text"][:80] for r in fresh if len(r["text"]) >= 80])]
    assert got[0] >= 0.8 and got[1] >= 0.4 and got[2] <= 0.02 and got[3] <= 0.05


def model_of(spark, make_docs, words):
    return T.CharModel(T.count_trigrams(make_docs([(i, w) for i, w in enumerate(words)])))


def test_trigram_counts(spark, make_docs):
    got = dict(T.count_trigrams(make_docs([(0, "ab--C"), (1, None), (2, ""), (3, "ab")])))
    code = lambda a, b, c: (a * 28 + b) * 28 + c
    assert got == {code(0, 1, 2): 2, code(1, 2, 0): 2, code(2, 0, 3): 1, code(0, 3, 0): 1}


@pytest.mark.parametrize("hidden, plain", [
    ("you 1d10t !", "idiot"), ("an i d i o t here", "idiot"), ("st.u.p.i.d", "stupid"), ("idiooooot", "idiot"),
    ("m0r0n", "moron"), ("$tup1d", "stupid"), ("l 0 s e r", "loser"), ("d-i-s-g-u-s-t", "disgust"), ("I.D.I.0.T!", "idiot")])
def test_restoration(spark, make_docs, hidden, plain):
    words = ["idiot stupid moron loser disgust and the here you an"] * 40
    r = T.Restorer(model_of(spark, make_docs, words))
    assert plain in r.restore(hidden.encode()).decode().split()
    assert r.restore(b"and the, Here.") == b"and the, here."


@pytest.mark.parametrize("hidden, plain", [
    ('"$tupid"', "stupid"), ("(1diot)", "idiot"), ("such an a$$!", "ass"), ("an [a$$]", "ass"), ("'m0r0n8'", "moronb"),
    ("i/d/i/o/t", "idiot"), ("l,o,s,e,r", "loser"), ("you i\td\ti\to\tt here", "idiot"), ("m\no\nr\no\nn", "moron"),
    ("m\r\no\r\nr\r\no\r\nn", "moron"), ("i.....d.....i.....o.....t", "idiot"), ("i - d - i - o - t", "idiot"),
    ("i\u200bd\u200bi\u200bo\u200bt", "idiot"), ("you mo\u00adron", "moron")])
def test_disguises_beside_marks(spark, make_docs, hidden, plain):
    words = ["idiot stupid moron moronb loser ass disgust and the here you an"] * 40
    r = T.Restorer(model_of(spark, make_docs, words))
    assert plain.encode() in r.restore(hidden.encode()).translate(T._LETTERS).split()
    assert r.restore(b'"and" (the) here!') == b'"and" (the) here!'


def test_viterbi_is_the_best_path(spark, make_docs):
    """Against all paths of short lattices."""
    m = model_of(spark, make_docs, ["abba cabal able", "bib bob lab sol", "o l i s"] * 5)
    r = T.Restorer(m)
    for span in ("a1b", "0ll", "b.b", "5 0 l", "aab", "1l.o"):
        best = -math.inf
        for path in itertools.product(*[r.arcs(c) + [("again", T.COST_REPEAT)] for c in span]):
            a = b = 0
            last, s = "", 0.0
            ok = True
            for ch, (x, cost) in zip(span, path):
                if x == "again":
                    opts = [c for y, c in r.arcs(ch) if y and y == last]
                    ok &= bool(opts)
                    s += max(opts, default=0) + cost
                elif x == "":
                    s += cost
                elif x == " ":
                    s += cost + (m.log[a][b][0] if b else 0.0)
                    a, b, last = (b, 0, "") if b else (a, 0, "")
                else:
                    s += cost + (m.log[a][b][T._code(x)] if b else m.start[T._code(x)])
                    a, b, last = b, T._code(x), x
            if ok:
                best = max(best, s + (m.log[a][b][0] if b else 0.0))
        got = r.decode(span)
        a = b = 0
        s = 0.0
        for x in got + " ":
            c = 0 if x == " " else T._code(x)
            if not (c == 0 and b == 0):
                s += m.log[a][b][c] if b else m.start[c]
            a, b = b, c
        assert s >= best - 1e-9, (span, got)  # the path's own costs are at most 0


def test_greedy_rules():
    docs = [(1, ["idiot", "idi-", "x-"])] * 6 + [(1, ["scum"])] * 5 + [(0, ["x-"])] * 20
    counts = {"idiot": (6, 6), "idi-": (6, 6), "scum": (5, 5), "x-": (6, 26)}
    assert set(T.greedy_rules(docs, counts)) == {"idiot", "scum"}
    assert set(T.strong_rules({"vequ-": (30, 30), "vequa-": (14, 14), "idiot": (90, 90), "idi-": (92, 95)}, 100)) == {"vequ-", "vequa-", "idiot"} \
        or set(T.strong_rules({"vequ-": (30, 30), "idiot": (90, 90), "idi-": (92, 95)}, 100)) == {"vequ-", "idiot"}


def test_toxicity_query(spark, make_docs, sf):
    rng = np.random.default_rng(0)
    plain = ["river", "stone", "cloud", "green", "walks", "under", "light", "paper"]
    rows, labels = [], []
    for i in range(400):
        t = list(rng.choice(plain, 12))
        bad = i % 4 == 0
        if bad:
            t[3] = ["moron", "scumbag"][i % 8 // 4]
        rows.append((i, " ".join(t)))
        labels.append((i, 1, int(bad)))
    rows += [(1000, "river m0r0n stone"), (1001, "river s c u m b a g stone"), (1002, "scuuuumbag"), (1003, "river stone"),
             (1004, None), (1005, ""), (1006, "green " * 20000 + "MORON"), (1000, "light paper")]
    tables = dict(documents=make_docs(rows), labels=spark.createDataFrame(labels + [(0, 0, None), (None, 1, 1)],
                                                                             "doc_id bigint, quality int, toxic int"))
    out = QUERIES["op1_toxicity"](spark, sf(**tables)).collect()
    assert len(out) == len(rows) and all(0 <= r["score"] <= 1 for r in out)
    assert all(r["predicted"] == int(r["score"] >= 0.7) for r in out)
    by = {r["doc_id"]: r["predicted"] for r in out if r["doc_id"] != 1000}
    assert all(by[i] == int(i % 4 == 0) for i in range(400))
    assert [by[i] for i in range(1001, 1007)] == [1, 1, 0, 0, 0, 1]
    assert sorted(r["predicted"] for r in out if r["doc_id"] == 1000) == [0, 1]
    held = __import__("zlib").crc32(b"1001") % 3 == 1
    assert [r["held_out"] for r in out if r["doc_id"] == 1001] == [held]
    empty = sf(documents=tables["documents"].limit(0), labels=tables["labels"])
    assert QUERIES["op1_toxicity"](spark, empty).count() == 0
    unlabelled = sf(documents=tables["documents"], labels=tables["labels"].limit(0))
    assert {r["predicted"] for r in QUERIES["op1_toxicity"](spark, unlabelled).collect()} == {0}
