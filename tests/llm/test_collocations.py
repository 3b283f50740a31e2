"""Collocations against brute force, with many collisions, small blocks and full sketches, and against SQL."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from compare import compare, duck
from conftest import SF_SMALL
from llm_fixtures import make_docs, sf  # noqa: F401
from riskloom.llm import collocations as C
from riskloom.llm.oracle import queries as oracle

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def pieces(text):
    for piece in re.split(r"[.,;:!?\n-\r]", (text or "").translate(LOW)):
        yield [x for x in re.split(r"[ \t]+", piece) if x]


def brute(rows, least=30, top=2000):
    count, total, by = Counter(), Counter(), defaultdict(list)
    for _, text, lang in rows:
        lang = lang or "und"
        for w in pieces(text):
            total[lang] += len(w)
            count.update((lang, *w[i:i + n]) for n in range(1, 5) for i in range(len(w) - n + 1))
    cand = {k: a for k, a in count.items() if len(k) > 2 and a >= least}
    gone = {(k[0], *k[i:i + m]) for k, a in cand.items() for m in range(2, len(k) - 1) for i in range(1, len(k) - m + 1)
            if 100 * a >= 80 * cand[(k[0], *k[i:i + m])]}
    for k, a in cand.items():
        if k not in gone:
            cuts = [(count[k[:1 + c]], count[(k[0], *k[1 + c:])]) for c in range(1, len(k) - 1)]
            score, _, le, r = min((2000000 * a // (le + r), c, le, r) for c, (le, r) in enumerate(cuts))
            by[k[0]].append((-score, -a, " ".join(k[1:]).encode(), le, r))
    return sorted((lang, i + 1, x[2].decode(), -x[1], x[3], x[4], total[lang], -x[0])
                  for lang, v in by.items() for i, x in enumerate(sorted(v)[:top]))


def rows_of(seed, n=150):
    rnd = random.Random(seed)
    words = ["the", "of", "New", "york", "city", "a b", "été", "x-y", "日本", "#", "it's", "THE", "wall", "street"]
    fixed = ["New York City hall", "été à la", "x-y # x-y", "the the the the the"]
    rows = [(0, None, "en"), (1, "", "en"), (2, " .\n,;\t ", None), (3, "one word", None)]
    for i in range(4, n):
        out = []
        for _ in range(rnd.randint(1, 40)):
            out.append(rnd.choice(fixed) if rnd.random() < 0.3 else rnd.choice(words))
            out.append(rnd.choice([" ", " ", " ", "  ", "\t", ". ", "\n", ", ", "!"]))
        rows.append((i, "".join(out), rnd.choice(["en", "en", "fr", None])))
    rows += [rows[-1], rows[-1], (None, "new york city " * 40, "fr"), (n, ("wall street " * 7000) + "x" * 9000 + " of the " + "y" * 200, "de")]
    return rows


def mined(docs, least=30, top=2000, bits=64):
    got = C.collocations(*C.frequent_phrases(docs, min_count=least, bits=bits), top=top)
    return sorted(tuple(r) for r in got.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


def docs_of(make_docs, rows):
    return make_docs([(i, t, lang) for i, t, lang in rows]).withColumn("t", F.lit(1)).withColumn("h", F.lit("x")).withColumn("f", F.lit(2))


@pytest.mark.parametrize("seed", [1, 2])
def test_brute_force(spark, make_docs, seed):
    rows = rows_of(seed)
    assert mined(docs_of(make_docs, rows)) == brute(rows)


def test_low_counts_and_top(spark, make_docs):
    rows = rows_of(3, 60)
    assert mined(docs_of(make_docs, rows), least=2, top=50) == brute(rows, least=2, top=50)


@pytest.mark.parametrize("bits", [4, 9])
def test_collisions_are_counted_by_text(spark, make_docs, bits):
    rows = rows_of(4, 60)
    assert mined(docs_of(make_docs, rows), least=3, bits=bits) == brute(rows, least=3)


def test_empty_table(spark, make_docs):
    assert mined(make_docs([])) == []


def test_blocks_see_every_ngram_once():
    """N-grams of texts cut into blocks of any size equal those of the whole text."""
    hashes = C.Hashes()
    rnd = random.Random(7)
    texts = [t for _, t, _ in rows_of(5, 30)] + ["a bb " * 300, "z" * 500, "w " + "v" * 400 + " u t s", "é" * 90 + " b c d e"]
    texts = [None if t is None else t[:6000].encode() for t in texts]
    expect = Counter()
    for t in texts:
        for w in pieces((t or b"").decode("utf-8", "ignore")):
            for n in range(1, 5):
                expect[n] += max(0, len(w) - n + 1)
    found = {}
    for size in (1 << 20, 7, 64, 200, rnd.randint(300, 900)):
        got = Counter()
        for block in C.blocks(texts, [9] * len(texts), size):
            for n, (one, two) in enumerate(zip(block.grams(hashes, 0), block.grams(hashes, 1)), 1):
                for i in np.flatnonzero(block.valid(n)):
                    got[n, int(one[i]), int(two[i]), int(block.text[i]), int(block.offset[i])] += 1
        assert max(got.values()) == 1
        found.setdefault("all", got)
        assert got == found["all"]
    assert Counter(k[0] for k in found["all"]) == expect


def test_fingerprints_differ_by_language_and_length():
    hashes = C.Hashes()
    a, b = (next(C.blocks([b"x y x y"], [s])).grams(hashes, 0) for s in (C.lang_seed("en"), C.lang_seed("fr")))
    assert a[0][0] == a[0][2] and a[1][0] == a[1][2] and a[0][0] != a[0][1]
    assert not set(map(int, np.concatenate(a))) & set(map(int, np.concatenate(b)))


def test_sql(spark):
    ok, msg = compare(C.op13_collocations(spark, SF_SMALL), duck(SF_SMALL), oracle()["op13_collocations"])
    assert ok, msg


@pytest.mark.parametrize("most", [100, 1 << 20])
def test_a_fingerprint_leaves_a_task_once(monkeypatch, most):
    """Many blocks with the same fingerprints: one row each, whatever is compacted between, unless the table is full."""
    monkeypatch.setattr(C, "COMPACT_ROWS", 500)
    monkeypatch.setattr(C, "TABLE_ROWS", most)
    rng, want, blocks = np.random.default_rng(7), defaultdict(lambda: [1 << 62, -1, 0, set()]), []
    for _ in range(60):
        h = np.unique(rng.integers(-400, 400, 200))
        low, n, t = rng.integers(0, 9, len(h)), rng.integers(1, 5, len(h)), rng.integers(0, 1 << 40, len(h))
        blocks.append([h, low, low + 1, n, t, t + 1])
        for x, lo, c, p in zip(*(v.tolist() for v in (h, low, n, t))):
            w = want[x]
            want[x] = [min(w[0], lo), max(w[1], lo + 1), w[2] + c, w[3] | {p}]
    tables = list(C._tables(iter([list(b) for b in blocks])))
    assert all((np.diff(x[0]) > 0).all() for x in tables) and (len(tables) == 1) == (most > 800)
    got = {}
    for x in tables:
        for h, lo, hi, n, t, at in zip(*(c.tolist() for c in x)):
            w = got.get(h, [1 << 62, -1, 0])
            got[h] = [min(w[0], lo), max(w[1], hi), w[2] + n]
            assert t in want[h][3] and at == t + 1
    assert got == {h: w[:3] for h, w in want.items()}


def test_columns_are_packed_and_unpacked():
    rng = np.random.default_rng(3)
    for n in (1, 7, 5000):
        columns = [np.sort(rng.integers(0, 1 << 63, n).astype(np.uint64) * np.uint64(2) + np.uint64(1)), np.zeros(n, np.uint64),
                   rng.integers(0, 3, n).astype(np.uint64), rng.integers(0, 1 << 20, n).astype(np.uint64), np.full(n, (1 << 64) - 1, np.uint64)]
        assert all((x == y).all() for x, y in zip(columns, C._unpack(C._pack(columns)), strict=True))


def test_rare_phrases_stay_out_whatever_the_bit_map_holds(spark, make_docs):
    """Many more different phrases than buckets, a few occurrences each: only the buckets of frequent ones are set."""
    rnd = random.Random(11)
    rows = [(i, " ".join(rnd.choice(("new york city", f"w{rnd.randrange(60_000)}")) for _ in range(600)), "en") for i in range(300)]
    count = Counter(tuple(w[i:i + n]) for _, t, _ in rows for w in [t.split()] for n in range(1, 5) for i in range(len(w) - n + 1))
    frequent = sum(c >= 30 for c in count.values())
    assert len(count) > 3 * C.MIN_BUCKETS and frequent < 100
    docs = C._texts(docs_of(make_docs, rows), "doc_id", "text", "lang")
    bitmap, totals, most = C.can_be_frequent(docs, sum(len(t) for _, t, _ in rows), C.MIN_BUCKETS, 30, 64)
    assert 0 < np.unpackbits(np.frombuffer(bitmap, np.uint8)).sum() <= frequent and most >= frequent
    assert [tuple(r) for r in totals.collect()] == [("en", sum(c for k, c in count.items() if len(k) == 1))]


def test_many_ranges_and_small_tables(spark, make_docs, monkeypatch):
    for name, value in (("KEYS", 400), ("RANGE_BYTES", 1 << 14), ("RANGE_ROWS", 200)):
        monkeypatch.setattr(C, name, value)
    rows = rows_of(6, 60)
    assert mined(docs_of(make_docs, rows), least=3) == brute(rows, least=3)
