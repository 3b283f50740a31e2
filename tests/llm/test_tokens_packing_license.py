"""Token counts against the tokenizer, packing round trips, license scans against plain alignment."""

import random
from collections import defaultdict

import numpy as np
import pytest

from llm_fixtures import make_docs, sf  # noqa: F401
from riskloom.llm import license_scan as L
from riskloom.llm import packing as P
from riskloom.llm import token_count as T

ODD = ["", " ", "a", "  a  b", "▁▁x", "日本語 テキスト😀😀 a", "\n\n\n x\ty", "a" * 400, "<0x41> <s>", " x ", "x  ", "né à ß"]


def unigram(vocab, unk, byte_fallback):
    from tokenizers import Tokenizer, models, pre_tokenizers
    t = Tokenizer(models.Unigram(vocab, unk_id=unk, byte_fallback=byte_fallback))
    t.pre_tokenizer = pre_tokenizers.Metaspace(replacement=T.MARK, prepend_scheme="always", split=True)
    return lambda x: len(t.encode(x, add_special_tokens=False).ids)


def texts():
    rnd = random.Random(1)
    return ODD + ["".join(rnd.choice("ab ▁é\n日<s>0x1") for _ in range(40)) for _ in range(300)]


def test_counts_equal_the_tokenizer():
    vocab, unk = T.load_vocabulary(T.TOKENIZER)
    counter, want = T.PieceCounter(vocab, memo=50), unigram(vocab, unk, True)
    assert [counter.text(x) for x in texts()] == [want(x) for x in texts()]
    assert counter.text(None) == 0


def test_ties_without_byte_pieces():
    """Scores full of ties, and runs of unknown characters that are one piece."""
    vocab = [("<unk>", 0.0), (T.MARK, -1.0), ("a", -1.0), ("b", -1.0), ("ab", -2.0), ("aa", -2.0), ("ba", -2.0),
             ("aba", -3.0), (T.MARK + "a", -2.0), ("bab", -2.5)]
    counter, want = T.PieceCounter(vocab), unigram(vocab, 0, False)
    rnd = random.Random(2)
    for _ in range(500):
        x = "".join(rnd.choice("aab b??") for _ in range(rnd.randint(0, 14)))
        assert counter.text(x) == want(x), x


def test_count_query(spark, make_docs, sf):
    from riskloom.llm.queries import QUERIES
    rows = list(enumerate(texts())) + [(1000, None), (3, ODD[3])]
    vocab, unk = T.load_vocabulary(T.TOKENIZER)
    want = unigram(vocab, unk, True)
    out = QUERIES["op2_token_counts"](spark, sf(documents=make_docs(rows))).collect()
    assert sorted((r[0], r[1]) for r in out) == sorted((i, want(t) if t else 0) for i, t in rows)


@pytest.mark.parametrize("width", [1, 5, 16, 64])
def test_best_fit_decreasing(width):
    rnd = random.Random(width)
    lens = [rnd.randint(1, width) for _ in range(400)]
    rows = P.best_fit_decreasing(lens, width)
    assert sorted(i for r in rows for i in r) == list(range(400))
    free: list[int] = []
    want: list[list[int]] = []
    for i in sorted(range(400), key=lambda j: -lens[j]):
        fits = [b for b in range(len(free)) if free[b] >= lens[i]]
        if not fits:
            free.append(width)
            want.append([])
            fits = [len(free) - 1]
        b = min(fits, key=lambda b: free[b])
        free[b] -= lens[i]
        want[b].append(i)
    assert sorted(sum(lens[i] for i in r) for r in rows) == sorted(sum(lens[i] for i in r) for r in want)


def test_packing_round_trip(spark, make_docs):
    enc = P.load_encoding(P.TOKENIZER)
    rnd = random.Random(4)
    rows = [(i, "".join(rnd.choice("ab cé日\n.") for _ in range(rnd.choice([0, 3, 40, 700])))) for i in range(120)]
    rows += [(None, "no id"), (500, None), (501, ""), (7, rows[7][1]), (502, "word " * 3000)]
    for group in (P.GROUP_TOKENS, 300):
        out = P.pack(make_docs(rows), width=64, group_tokens=group).collect()
        parts = defaultdict(list)
        for r in out:
            assert len(r["ids"]) == 128 and r["cu_seqlens"][0] == 0 and r["cu_seqlens"][-1] == r["n_tokens"]
            assert r["position_resets"] == r["cu_seqlens"][:-1]
            assert (np.frombuffer(r["ids"], "<u2")[r["n_tokens"]:] == enc.n_vocab).all()
            for d, s, ids in P.unpack(r["ids"], r["cu_seqlens"], r["doc_ids"], r["seg_starts"]):
                parts[d].append((s, ids.tolist()))
        want = defaultdict(list)
        for d, t in rows:
            ids = enc.encode_ordinary(t or "")
            want[d] += [(i, ids[i:i + 64]) for i in range(0, len(ids), 64)]
        assert {k: sorted(v) for k, v in parts.items()} == {k: sorted(v) for k, v in want.items() if v}
    assert P.pack(make_docs(rows).limit(0)).count() == 0


def plain(text, template, a0=0, b0=0):
    """Recursive patience alignment with a quadratic subsequence search."""
    ua = [w for w in set(text) if text.count(w) == 1 and template.count(w) == 1]
    pairs = sorted((text.index(w), template.index(w)) for w in ua)
    best = [[] for _ in pairs]
    for i, p in enumerate(pairs):
        best[i] = max((best[k] for k in range(i) if pairs[k][1] < p[1]), key=len, default=[]) + [p]
    kept = max(best, key=len, default=[])
    if not kept:
        return 0
    n, pa, pb = len(kept), -1, -1
    for i, j in [*kept, (len(text), len(template))]:
        n += plain(text[pa + 1:i], template[pb + 1:j])
        pa, pb = i, j
    return n


def test_patience():
    assert L.increasing([3, 1, 2, 5, 4]) in ([1, 2, 4], [1, 2, 3])
    rnd = random.Random(6)
    for _ in range(200):
        template = [rnd.choice("abcdefgh") for _ in range(rnd.randint(1, 9))]
        text = [rnd.choice("abcdefghij") for _ in range(rnd.randint(0, 14))]
        got = L.patience(text, template)
        assert all(text[i] == template[j] for i, j in got)
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(got, got[1:]))
        if len(set(template)) == len(template) and len(set(text)) == len(text):
            assert len(got) == plain(text, template)


def test_license_query(spark, make_docs, sf):
    from riskloom.llm.queries import QUERIES
    mit = L.TEMPLATES["MIT"]
    words = mit.split()
    changed = " ".join("zz" if i % 9 == 4 else w for i, w in enumerate(words))
    rows = [(0, None), (1, ""), (2, "the license of this software is granted to any person"), (3, "intro\n" + mit.upper() + "\nend"),
            (4, changed), (5, "x " * 30000 + "Released under the MIT License." + " y" * 30000),
            (6, "Released under the MIT License.\nReleased under the MIT License.\n"),
            (7, " ".join("zz" if i % 2 else w for i, w in enumerate(words))), (8, L.TEMPLATES["Apache-2.0-notice"]), (6, "dup")]
    out = defaultdict(list)
    for r in QUERIES["op6_license_scan"](spark, sf(documents=make_docs(rows))).collect():
        out[r["doc_id"]].append(r)
    one = {k: v[0] for k, v in out.items() if len(v) == 1}
    assert [one[k]["license"] for k in (0, 1, 2, 7)] == [None] * 4 and one[0]["coverage"] == 0.0
    assert one[3]["license"] == "MIT" and one[3]["coverage"] > 0.95
    assert one[4]["license"] == "MIT" and 0.8 <= one[4]["coverage"] < 0.95
    assert one[5]["license"] == "MIT-line" and one[5]["finds"][0]["start_word"] == 30000
    assert one[8]["license"] == "Apache-2.0-notice"
    assert sorted(r["n_finds"] for r in out[6]) == [0, 2]


@pytest.mark.parametrize("name", sorted(L.TEMPLATES))
def test_whole_notice_behind_prose(name):
    """Prose full of template words before a notice takes nothing off the find."""
    rnd = random.Random(3)
    pool = ("the of to in a use this software without and any or you may all copy program under house river went green "
            "seven walked letter morning").split()
    n = len(L.words_of(L.TEMPLATES[name].encode()))
    for prose in (100, 200, 400):
        around = " ".join(rnd.choice(pool) for _ in range(prose))
        _, best, coverage, _, finds = L.LicenseScanner(L.TEMPLATES).scan(f"{around} {L.TEMPLATES[name]} {around}".encode())
        assert (best, coverage) == (name, 1.0)
        assert [(f["start_word"], f["end_word"]) for f in finds if f["license"] == name] == [(prose, prose + n)]


def test_changed_copies_behind_prose():
    """A worn copy is measured from its own words, and does not swallow the exact copy behind it."""
    words = L.TEMPLATES["MIT"].split()
    worn = ["zz" if i % 10 == 4 else w for i, w in enumerate(words)]
    prose = ("the software and this permission of the house to any person " * 20).split()
    scan = L.LicenseScanner({"MIT": L.TEMPLATES["MIT"]}).scan
    alone = scan(" ".join(worn).encode())[4][0]
    finds = scan(" ".join([*prose, *worn, *words]).encode())[4]
    assert [f["coverage"] for f in finds] == [alone["coverage"], 1.0]
    assert finds[0]["end_word"] - len(L.words_of(" ".join(prose).encode())) == alone["end_word"]
