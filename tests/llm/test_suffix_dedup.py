"""Suffix dedup against brute force over every byte position."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm_fixtures import make_docs, sf  # noqa: F401
from riskloom.llm import suffix_dedup as S


def brute(rows, length):
    raw = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(t[p:p + length] for _, t in raw for p in range(len(t) - length + 1))
    out = []
    for i, t in raw:
        cov = np.zeros(len(t), bool)
        for p in range(len(t) - length + 1):
            if seen[t[p:p + length]] > 1:
                cov[p:p + length] = True
        kept = bytes(np.frombuffer(t, np.uint8)[~cov])
        runs = int((np.diff(np.concatenate([[0], cov.astype(int)])) == 1).sum())
        out.append((i, len(t), int(cov.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def digest(df):
    return sorted(((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in df.collect()), key=str)


def text_rows(seed, n=60):
    rnd = random.Random(seed)
    char = lambda k: "".join(rnd.choice("abcdefghij é\n") for _ in range(k))
    shared = [char(k) for k in (300, 399, 400, 401, 700, 1500)]
    rows = [(0, None), (1, ""), (2, "x" * 399), (3, "x" * 1000), (4, "ab" * 600), (5, char(900)), (6, char(400))]
    rows += [(7, rows[6][1]), (8, rows[5][1][:-1] + "?"), (9, "!" + rows[5][1][1:]), (5, rows[5][1])]
    for i in range(10, n):
        t = char(rnd.choice([0, 10, 500, 1200]))
        for _ in range(rnd.randint(0, 3)):
            s = rnd.choice(shared)
            a = rnd.randint(0, len(s) // 2)
            cut = s[a:rnd.randint(a, len(s))] if rnd.random() < 0.6 else s
            t += cut + char(rnd.choice([0, 1, 30, 300]))
        rows.append((i, t))
    # a passage with itself overlapping, and a near copy with one change in the middle
    rows.append((n, "abc" * 500 + char(50) + "abc" * 300))
    rows.append((n + 1, rows[30][1][:700] + "#" + rows[30][1][701:]))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_brute_force(spark, make_docs, sf, seed):
    from riskloom.llm.queries import QUERIES
    rows = text_rows(seed)
    out = QUERIES["op5_suffix_dedup"](spark, sf(documents=make_docs(rows)))
    assert digest(out) == brute(rows, 400)


def test_equal_rows_are_doubled_once(spark, make_docs):
    """Rows equal in id and text are one group of phrases with a number of copies, however many there are."""
    rnd = random.Random(8)
    long, other = ("".join(rnd.choice("abcdefghij") for _ in range(2000)) for _ in range(2))
    rows = [(1, long)] * 30 + [(None, other)] * 20 + [(2, other[300:1500]), (3, "".join(rnd.choice("klmn") for _ in range(900)))]
    sigs = S.signatures(make_docs(rows), 400)
    assert sorted(r["w"] for r in sigs.collect()) == [1, 1, 2, 2]
    level = S.rerank(S.phrase_rows(sigs, 400))
    got = S.rerank(S.double(level, 1)).collect()
    assert len({(r["sid"], r["i"]) for r in got}) == len(got) > 0
    # one rank a repeated pair, the same wherever it stands
    flat = {r["sid"]: r["w"] for r in got}
    assert sorted(flat.values()) == [1, 2, 2]
    assert digest(S.dedup(make_docs(rows))) == brute(rows, 400)


def test_other_length(spark, make_docs):
    rows = text_rows(3, 40)
    assert digest(S.dedup(make_docs(rows), 256)) == brute(rows, 256)
    with pytest.raises(ValueError):
        S.dedup(make_docs(rows), 100)


def test_empty_and_single(spark, make_docs):
    assert S.dedup(make_docs([(1, "a")]).limit(0)).count() == 0
    assert digest(S.dedup(make_docs([(1, "q" * 300), (2, None)]))) == brute([(1, "q" * 300), (2, None)], 400)


def test_names_and_anchors():
    rnd = random.Random(4)
    raw = bytes(rnd.choice(b"abcd") for _ in range(3000))
    t = S.Text(raw + raw[500:1500])
    a, b = np.arange(500, 900), np.arange(3000, 3400)
    assert (t.name(a, a + 400) == t.name(b, b + 400)).all()
    n = t.name(np.arange(2500), np.arange(2500) + 400)
    assert len(np.unique(n)) == len({raw[p:p + 400] for p in range(2500)})
    m = t.minima()
    assert (m >= np.arange(len(m))).all() and (m < np.arange(len(m)) + S.WINDOW).all()


def test_texts_together_equal_each_alone():
    """Phrases of texts that are hashed in one go are those of every text by itself; windows never cross a text's end."""
    rnd = random.Random(5)
    raws = [bytes(rnd.choice(b"abcdefgh ") for _ in range(rnd.randint(256, 2000))) for _ in range(20)] + [b"x" * 700, b"ab" * 300]
    off = np.concatenate([[0], np.cumsum([len(r) for r in raws])])
    s, e, lead = S.Text(b"".join(raws)).phrases(off)
    for d, raw in enumerate(raws):
        least = S.Text(raw).minima()
        b = np.unique(np.append(least, 0))
        of = (s >= off[d]) & (s < off[d + 1])
        assert (s[of] - off[d] == b).all()
        assert (e[of] - off[d] == np.minimum(np.append(b[1:] + S.GRAM, len(raw)), len(raw))).all()
        seen = (s - lead)[of & (lead != S.NO_ANCHOR)] - off[d]
        assert (seen == np.flatnonzero(np.diff(least, prepend=-1))).all()


def test_one_example_of_a_repeated_class(spark, make_docs):
    """A passage in many texts is one row per text and level in the rounds, and has its starts looked up at one place only."""
    rnd = random.Random(9)
    char = lambda k: "".join(rnd.choice("abcdefghij") for _ in range(k))
    passage = char(3000)
    rows = [(i, char(300) + passage + char(300)) for i in range(40)]
    sigs = S.signatures(make_docs(rows), 400)
    marks = S.levels(sigs, 400)
    assert S.by_text(S.rerank(S.phrase_rows(sigs, 400))).count() == 40
    classes = S.class_rows(marks, 400)
    sure = S.sure_classes(classes).collect()
    examples = [x for r in sure for x in r["s"] if x["example"]]
    assert len(sure) == 40 and len(examples) == classes.select("x", "y", "z").distinct().count()
    found = marks.join(S.sure_classes(classes), marks.sid == F.col("ssid"))
    opened = S.open_classes(found, 400).collect()
    held = [r for r in opened if not r["open"]]
    # the phrases at its ends go on into the texts, so a few starts have several classes
    assert 0 < sum(r["hi"] - r["lo"] + 1 for r in held) < 2 * len(passage)
    assert digest(S.dedup(make_docs(rows))) == brute(rows, 400)


def test_texts_longer_than_a_batch_and_a_group(spark, make_docs):
    """Texts that pass an Arrow batch of rows and the bytes worked on together, next to many short ones."""
    rnd = random.Random(11)
    char = lambda k: "".join(rnd.choice("abcdefghij") for _ in range(k))
    long = char(S.BYTES + 5000)
    rows = [(0, long), (1, char(50) + long[1000:-1000] + char(700)), (2, "ab" * 9000 + long[:500]), (3, "ab" * 9000 + "c")]
    rows += [(i, char(350) + long[i * 50:i * 50 + rnd.choice([399, 400, 450])] + char(40)) for i in range(4, 60)]
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    try:
        assert digest(S.dedup(make_docs(rows))) == brute(rows, 400)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
