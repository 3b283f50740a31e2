"""Toxicity of texts after noisy-channel deobfuscation.

Writers hide words by leetspeak (1d10t), spacing (i d i o t) and repetition
(idiooot). Stretches of a text that look so are turned into a lattice: every
character may stand for itself, for the letters it imitates, for nothing
(a separator, or a letter repeated), or for a word boundary. Viterbi picks the
best path under a character trigram model, which is counted over all texts.
The restored text is then scored.

The score comes from a list of rules (restored words and word beginnings)
learned by greedy covering from labelled texts: the rule that explains most
toxic texts at least cost is taken, the texts it explains are set aside, and
so on, until no rule is good enough. A feature that marks a fair share of the
toxic texts by itself is a rule too, though others explain its texts. A text scores 1 - prod(1 - precision)
over its rules; a text without a rule gets the rate of toxic texts that no
rule explains.

The model counts cover all texts (a table of at most 28^3 rows). Rules are
fitted on at most about ``FIT_DOCS`` labelled texts, chosen by a hash of the
text, repeated texts once.

Defined cases: null and empty texts have no rule and get the score of such
texts; without any labelled toxic text every score is that rate, too; repeated
rows score alike; several label rows of one document count as toxic if one
is; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import LOWER_TABLE, cut, held_out, map_text, read_table

FIT_DOCS = 20_000
THRESHOLD = 0.7
MIN_TOXIC = 4
#: a feature of this many toxic texts, and of this share of them, is a rule by itself at STRONG_PRECISION
STRONG_TOXIC, STRONG_SHARE, STRONG_PRECISION = 8, 0.05, 0.9
#: a clean text among those a rule explains costs as much as this many toxic ones gain
CLEAN_COST = 5
MIN_PRECISION = 0.8
PREFIXES = (4, 5, 6)

#: fixed values: letters that a character imitates in leetspeak
LEET = {"0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s",
        "!": "i", "|": "il", "+": "t"}
SEPARATORS = " .-_*/,;:~#^=&%?'\"`\\()[]{}<>"
#: log costs of the channel
COST_LEET, COST_DROP, COST_REPEAT, COST_KEEP = -1.0, -0.5, -2.0, -12.0
#: a word boundary at a single separator between single characters
COST_SPLIT = -5.0

_K = 28  # 0 boundary, 1-26 letters, 27 any byte of another letter
_CODE = np.array([b - 96 if 97 <= b <= 122 else b - 64 if 65 <= b <= 90 else 27 if b >= 128 else 0
                  for b in range(256)], np.int64)
#: a leading or trailing imitation may stand beside any mark; a "!" behind a word alone is left as the sentence's end
_INNER = re.compile(rb"[a-z\x80-\xff][0-9@$!|+*._-]+[a-z\x80-\xff]|(?<![a-z0-9@$!|+\x80-\xff])[0-9@$!|+]++[a-z\x80-\xff]"
                    rb"|[a-z\x80-\xff]!*[01345789@$|+]")
_SPACED = re.compile(rb"(?<![a-z0-9\x80-\xff])(?:[a-z0-9@$!|+][^a-z0-9@$!|+\x80-\xff]++){2,}[a-z0-9@$!|+](?![a-z0-9\x80-\xff])")
_GAPS = re.compile(r"[^a-z0-9@$!|+\x80-\U0010ffff]+")
#: characters without width stand for nothing: zero-width space and joiners, word joiner, byte order mark, soft hyphen
_NO_WIDTH = re.compile(rb"\xe2\x80[\x8b-\x8d]|\xe2\x81\xa0|\xef\xbb\xbf|\xc2\xad")
_LETTERS = bytes(b if 97 <= b <= 122 or b >= 128 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))


def trigrams(text: bytes) -> np.ndarray:
    """Codes of the character trigrams of a text; runs of non-letters are one boundary."""
    c = _CODE[np.frombuffer(b" " + text + b" ", np.uint8)]
    c = c[np.concatenate([[True], (c[1:] != 0) | (c[:-1] != 0)])]
    return (c[:-2] * _K + c[1:-1]) * _K + c[2:]


def count_trigrams(docs: DataFrame, text: str = "text") -> list[tuple[int, int]]:
    """[(trigram code, count)] over all texts; summed in each task first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(_K ** 3, np.int64)
        for b in batches:
            for t in b.column(0).to_pylist():
                if t:
                    g = trigrams(t)
                    if len(g) > 4096:
                        total += np.bincount(g, minlength=_K ** 3)
                    else:
                        np.add.at(total, g, 1)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["g", "n"])
    rows = docs.select(F.col(text).cast("string").cast("binary").alias("t")).mapInArrow(run, "g bigint, n bigint")
    return [(r["g"], r["n"]) for r in rows.groupBy("g").agg(F.sum("n").alias("n")).collect()]


class CharModel:
    """log P(c | a, b), smoothed with the bigram and a uniform share."""

    def __init__(self, counts: list[tuple[int, int]]) -> None:
        c3 = np.zeros(_K ** 3)
        for g, n in counts:
            c3[g] = n
        c3 = c3.reshape(_K, _K, _K)
        c2 = c3.sum(0)
        p1 = (c2.sum(0) + 1) / (c2.sum() + _K)
        p2 = (c2 + 5 * p1) / (c2.sum(1, keepdims=True) + 5)
        p3 = (c3 + 5 * p2[None]) / (c3.sum(2, keepdims=True) + 5)
        self.log = np.log(p3).tolist()
        self.start = np.log(p2[0]).tolist()


def _code(ch: str) -> int:
    return ord(ch) - 96 if "a" <= ch <= "z" else 27


def single_gaps(span: str) -> str:
    """Characters spaced by two or more marks throughout: the shortest gap between them counts as one separator."""
    short = min((len(g) for g in _GAPS.findall(span)), default=1)
    return _GAPS.sub(lambda m: " " if len(m[0]) == short else m[0], span) if short > 1 else span


class Restorer:
    """Viterbi over the lattice of a stretch of text; restores whole texts."""

    def __init__(self, model: CharModel, memo: int = 100_000) -> None:
        self.m, self.memo, self.most = model, {}, memo

    def arcs(self, ch: str, split: float = 0.0) -> list[tuple[str, float]]:
        """(letter, cost) choices of one character; '' drops it, ' ' is a boundary (at a separator: of cost ``split``)."""
        if ch.isalpha():
            return [(ch, 0.0)]
        out = [(x, COST_LEET) for x in LEET.get(ch, "")]
        if ch in SEPARATORS or ch.isspace():
            out += [("", COST_DROP), (" ", split)]
        elif not ch.isdigit():
            out += [("", COST_DROP), (" ", COST_DROP)]
        else:
            out.append((" ", COST_KEEP))
        return out

    def decode(self, span: str, spaced: bool = False) -> str:
        """Best path through the lattice of ``span`` under the model, boundaries as spaces."""
        got = self.memo.get((span, spaced))
        if got is not None:
            return got
        log, start = self.m.log, self.m.start
        written = single_gaps(span) if spaced else span
        # state: last two codes and the last letter; value: score and a linked list of letters
        states = {(0, 0, ""): (0.0, None)}
        before = ""
        for ch in written:
            arcs = self.arcs(ch, COST_SPLIT if spaced and before.isalnum() else 0.0)
            before = ch
            new: dict = {}
            for (a, b, last), (score, path) in states.items():
                for x, cost in arcs:
                    if x == "":
                        key, s, p = (a, b, last), score + cost, path
                    elif x == " ":
                        key = (b, 0, "") if b else (a, 0, "")
                        s = score + cost + (log[a][b][0] if b else 0.0)
                        p = (path, " ") if b else path
                    else:
                        c = _code(x)
                        key, s, p = (b, c, x), score + cost + (log[a][b][c] if b else start[c]), (path, x)
                        if x == last:  # the letter again: an emphasis that stands for nothing
                            r = score + cost + COST_REPEAT
                            old = new.get((a, b, last))
                            if old is None or r > old[0]:
                                new[(a, b, last)] = (r, path)
                    old = new.get(key)
                    if old is None or s > old[0]:
                        new[key] = (s, p)
            states = new
        best = max(((s + (log[a][b][0] if b else 0.0), p) for (a, b, _), (s, p) in states.items()),
                   key=lambda x: x[0], default=(0.0, None))
        out, p = [], best[1]
        while p is not None:
            p, x = p
            out.append(x)
        got = "".join(reversed(out))
        if len(self.memo) >= self.most:
            self.memo.clear()
        if len(span) <= 64:
            self.memo[span, spaced] = got
        return got

    def spans(self, low: bytes) -> list[tuple[int, int, bool]]:
        """Stretches that look disguised: whole white-space tokens, or runs of single characters (True)."""
        out = [(*m.span(), True) for m in _SPACED.finditer(low)]
        cores = [m.span() for m in _INNER.finditer(low)]
        a = np.frombuffer(low, np.uint8)
        if len(a) > 2:
            letter = (a >= 97) & (a <= 122)
            cores += [(i, i + 3) for i in np.flatnonzero((a[2:] == a[1:-1]) & (a[1:-1] == a[:-2]) & letter[2:]).tolist()]
        if cores:
            space = np.flatnonzero((a == 32) | ((a >= 9) & (a <= 13)))
            lo = np.searchsorted(space, [x for x, _ in cores])
            starts = np.concatenate([[-1], space])[lo] + 1
            ends = np.concatenate([space, [len(a)]])[lo]
            # a core that crosses white space starts at its last token
            out += [(s, max(e, y), False) for s, e, (_, y) in zip(starts.tolist(), ends.tolist(), cores)]
        out.sort()
        merged: list[tuple[int, int, bool]] = []
        for s, e, spaced in out:
            if merged and s < merged[-1][1]:
                merged[-1] = (merged[-1][0], max(e, merged[-1][1]), spaced or merged[-1][2])
            else:
                merged.append((s, e, spaced))
        return merged

    def restore(self, text: bytes | None) -> bytes:
        """The lower-cased text with its disguised stretches decoded."""
        if not text:
            return b""
        low = _NO_WIDTH.sub(b"", text.translate(LOWER_TABLE))
        spans = self.spans(low)
        if not spans:
            return low
        out, at = [], 0
        for s, e, spaced in spans:
            out += [low[at:s], self.decode(low[s:e].decode(errors="replace"), spaced).encode()]
            at = e
        return b"".join([*out, low[at:]])


def words(restored: bytes) -> set[bytes]:
    """Distinct words of a restored text, repeated letters written once."""
    a = np.frombuffer(restored.translate(_LETTERS), np.uint8)
    if not len(a):
        return set()
    keep = np.concatenate([[True], a[1:] != a[:-1]])
    return set(a[keep].tobytes().split())


def features(restored: bytes) -> set[str]:
    ws = words(restored)
    out = {w.decode(errors="replace") for w in ws}
    for k in PREFIXES:
        out |= {w[:k].decode(errors="replace") + "-" for w in ws if len(w) >= k}
    return out


def greedy_rules(docs: list[tuple[int, list[str]]], counts: dict[str, tuple[int, int]]) -> dict[str, float]:
    """{rule: precision} by covering; ``docs``: (label, candidate features), ``counts``: (toxic, all) texts."""
    left = {i: d for i, d in enumerate(docs)}
    toxic, clean = Counter(), Counter()
    having: dict[str, list[int]] = {}
    for i, (y, fs) in left.items():
        (toxic if y else clean).update(fs)
        for f in fs:
            having.setdefault(f, []).append(i)
    rules: dict[str, float] = {}
    while toxic:
        # ties: whole words first, then the longer beginning, then by name
        f = max(toxic, key=lambda f: (toxic[f] - CLEAN_COST * clean[f], f[-1] != "-", len(f), f))
        t, n = counts[f]
        if toxic[f] < MIN_TOXIC or toxic[f] - CLEAN_COST * clean[f] <= 0 or (t + 0.5) / (n + 1) < MIN_PRECISION:
            break
        rules[f] = (t + 0.5) / (n + 1)
        for i in having[f]:
            if i in left:
                y, fs = left.pop(i)
                (toxic if y else clean).subtract(fs)
        toxic = +toxic
    return rules


def strong_rules(counts: dict[str, tuple[int, int]], t_all: int) -> dict[str, float]:
    """Features that mark a fair share of the toxic texts; a beginning only where no word of it does so as well."""
    strong = {f: (t + 0.5) / (n + 1) for f, (t, n) in counts.items()
              if t >= max(STRONG_TOXIC, STRONG_SHARE * t_all) and (t + 0.5) / (n + 1) >= STRONG_PRECISION}

    def covered(f):
        longer = (g for g in strong if g != f and g.startswith(f[:-1]) and (g[-1] != "-" or len(g) > len(f)))
        return any(counts[g][0] >= 0.8 * counts[f][0] for g in longer)
    return {f: p for f, p in strong.items() if f[-1] != "-" or not covered(f)}


def fit_rules(train: DataFrame, model: CharModel, fit_docs: int = FIT_DOCS) -> tuple[dict[str, float], float]:
    """Rules from labelled texts (text, toxic 0/1)."""
    sent = train.sparkSession.sparkContext.broadcast(model)
    one = train.filter(F.col("toxic").isNotNull()).groupBy(F.xxhash64("text").alias("h")).agg(
        F.first("text").alias("text"), F.max("toxic").alias("toxic"))
    total = train.count()
    share = min(1.0, fit_docs / max(1, total))
    one = one.filter(F.pmod(F.xxhash64("h"), F.lit(1 << 30)) < share * (1 << 30))

    def restored():
        r = Restorer(sent.value)
        return lambda texts: ([sorted(features(r.restore(t))) for t in texts],)
    got = cut(map_text(one, ["toxic"], restored, "f array<string>"), "toxic-features")
    sizes = {r["toxic"]: r["n"] for r in got.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    t_all, n_all = sizes.get(1, 0), sum(sizes.values())
    if not t_all:
        return {}, 0.5 / (n_all + 1)
    # only features of toxic texts can be rules; their clean texts are counted for these alone
    flat = got.select("toxic", F.explode("f").alias("f"))
    t = flat.filter("toxic = 1").groupBy("f").agg(F.count(F.lit(1)).alias("t")).filter(F.col("t") >= MIN_TOXIC)
    both = flat.join(t, "f").groupBy("f").agg(F.first("t").alias("t"), F.count(F.lit(1)).alias("n"))
    good = both.filter((F.col("t") + 0.5) / (F.col("n") + 1) >= MIN_PRECISION)
    counts = {r["f"]: (r["t"], r["n"]) for r in good.collect()}
    mine = F.array_intersect("f", F.array(*[F.lit(f) for f in counts])) if len(counts) <= 2000 else None
    if mine is None:
        wanted = train.sparkSession.sparkContext.broadcast(frozenset(counts))
        mine = F.udf(lambda fs: [f for f in fs if f in wanted.value], "array<string>")("f")
    docs = [(r["toxic"], r["f"]) for r in got.select("toxic", mine.alias("f")).filter((F.size("f") > 0) | (F.col("toxic") == 1)).collect()]
    rules = greedy_rules(docs, counts)
    rules |= strong_rules(counts, t_all)
    with_rule = [y for y, fs in docs if any(f in rules for f in fs)]
    return rules, (t_all - sum(with_rule) + 0.5) / (n_all - len(with_rule) + 1)


def score_texts(docs: DataFrame, keep: list[str], model: CharModel, rules: dict[str, float], rest: float,
                text: str = "text") -> DataFrame:
    """``keep`` columns plus score and the rules found in the restored text."""
    sent = docs.sparkSession.sparkContext.broadcast((model, rules, rest))

    def make():
        model, rules, rest = sent.value
        r = Restorer(model)
        whole = {k.encode(): k for k in rules if not k.endswith("-")}
        sizes = sorted({len(k[:-1].encode()) for k in rules if k.endswith("-")})
        begins = {k[:-1].encode(): k for k in rules if k.endswith("-")}

        def one(t):
            ws = words(r.restore(t)) if rules else ()
            hit = [whole[w] for w in whole.keys() & ws] if ws else []
            for k in sizes:
                hit += [begins[b] for b in begins.keys() & {w[:k] for w in ws} if len(b) == k]
            miss = math.prod(1 - rules[h] for h in hit)
            return (1 - miss, sorted(hit)) if hit else (rest, [])

        def f(texts):
            rows = [one(t) for t in texts]
            return [list(c) for c in zip(*rows)] if rows else [[], []]
        return f
    return map_text(docs, keep, make, "score double, rules array<string>", text=text)


def op1_toxicity(spark, sf_dir):
    """Toxicity of every document; rules from the labelled documents that are not held out."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = read_table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    model = CharModel(count_trigrams(docs))
    train = docs.filter(~held_out(F.col("doc_id"))).join(labels, "doc_id").select("text", "toxic")
    rules, rest = fit_rules(train, model)
    got = score_texts(docs, ["doc_id"], model, rules, rest)
    return got.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                      (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "rules")
