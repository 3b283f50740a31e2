"""Jaccard self-join of texts on word shingles with token-combination prefixes.

A text is the set of its distinct 5-word shingles (64-bit hashes). Texts with
the same set are one class. Two classes link when 100 * intersection >=
80 * union.

Candidates. All shingles have one order: rare ones first, each kind by
hash. A shingle is of the frequent kind when its bit is set in a bitmap of
fixed size, filled with the shingles that ``FREQUENT`` or more of all texts
have. That is a label only: any labelling gives the same links. Frequent
shingles are dealt into C small classes by hash. The prefix of a set is
extended until (rare shingles) + sum over classes of (shingles - 1) exceeds
the number of shingles a partner may lack. Then two linked sets share one
rare shingle, or two frequent shingles of one class, within their prefixes;
so rare shingles are indexed alone and frequent ones as pairs of a class.
C follows the size, and a set is indexed for its own size step and the one
below, so both sides of a link use the same C at least once.

Verification. Each set is first checked against the smallest one of each of
its index keys: sizes, then 16-bit sketches, which can only overstate the
overlap, then the sets themselves. Links are joined to components. Sets that
share the smallest set of a key form a cluster, dealt by size into groups so
that two sets of similar enough sizes are in one. Where a group still lies in
several components, it is dealt into blocks of bounded size. Every pair of
blocks is checked in one task: its overlaps are counted exactly, one by one or,
where there are many, by a product of 0/1 matrices in slices of the vocabulary, and only links that join two
components leave the task. The same is done with the sketches before, to keep
the sets that have a partner at all. So no link that matters to a component is lost, no
pair of sets becomes a row, and a group of m sets is copied m / BLOCK_SETS
times, not m times.

Defined cases: a text with fewer than five words has its whole word sequence
as its one shingle; null texts and texts without words have an empty set
and link with nothing; equal rows are one class; a component's id is its
smallest doc_id (null ids are passed over, a component of null ids has a null
id); rows that share a doc_id but not the text are told apart; an empty
table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from itertools import combinations, product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import ASCII_SPACE, LOWER_TABLE, cut, discard, read_table
from riskloom.llm.components import components

WORDS = 5
PERCENT = 80
#: a shingle in this many texts is of the frequent kind
FREQUENT = 16
LABEL_BITS = 1 << 26
#: shingles that a task adds up before they leave it
COMPACT_ROWS = 1 << 20
#: most sets and most shingles of a block of a cluster, on average; a group holds two blocks
BLOCK_SETS = 512
BLOCK_SHINGLES = 1 << 21
#: pairs of sets of two blocks up to which each is compared alone, not by a matrix product
FEW_PAIRS = 1024
#: vocabulary columns of one matrix slice
SLICE = 2048
BROADCAST_IDS = 2_000_000
#: bytes of text hashed in one numpy pass
TOGETHER = 1 << 17
_M = np.uint64(0xFF51AFD7ED558CCD)
_BASE = 0x9E3779B97F4A7C15
_LETTER = np.random.default_rng(20240305).integers(1, 1 << 63, 256, dtype=np.uint64)[np.frombuffer(LOWER_TABLE, np.uint8)]
_SPACE = np.isin(np.arange(256, dtype=np.uint8), np.frombuffer(ASCII_SPACE, np.uint8))


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(33))
    x = x * _M
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class _Powers:
    """Powers of the base and of its inverse (mod 2^64), grown on demand."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n >= len(self.up):
            size = max(n, 2 * len(self.up), 1 << 18)
            self.up, self.down = (np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(size, b, np.uint64))])
                                  for b in (_BASE, pow(_BASE, -1, 1 << 64)))
        return self.up, self.down


_powers = _Powers()


def _combined(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` words."""
    out = np.full(len(words) - size + 1, size, np.uint64)
    for j in range(size):
        out += words[j:j + len(out)] * _factor(j)
    return _mix(out)


def _factor(j: int) -> np.uint64:
    """Odd multiplier of a run's word ``j``."""
    return np.uint64(pow(_BASE, 2 * j + 1, 1 << 64))


def word_hashes(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(starts, hashes) of the lower-cased words: a polynomial over their bytes, mixed to 64 bits."""
    a = np.frombuffer(raw, np.uint8)
    edges = np.concatenate([[-1], np.flatnonzero(_SPACE[a]), [len(a)]])
    start, end = edges[:-1] + 1, edges[1:]
    some = end > start
    start, end = start[some], end[some]
    up, down = _powers.upto(len(a))
    total = np.zeros(len(a) + 1, np.uint64)
    np.cumsum(_LETTER[a] * up[:len(a)], out=total[1:])
    return start, _mix((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64))


def shingle_sets(texts: Iterable[bytes | None], n: int = WORDS) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text; short texts are hashed together."""
    held, size = [], 0
    for t in texts:
        held.append(t or b"")
        size += len(held[-1])
        if size >= TOGETHER:
            yield from _sets(held, n)
            held, size = [], 0
    yield from _sets(held, n)


def _sets(texts: list[bytes], n: int) -> Iterator[np.ndarray]:
    start, words = word_hashes(b"\n".join(texts))
    at = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])]) if texts else [0]
    bounds = np.searchsorted(start, at).tolist()
    runs = _combined(words, n) if len(words) >= n else words[:0]
    for lo, hi in zip(bounds, bounds[1:]):
        if hi - lo >= n:
            s = np.sort(runs[lo:hi - n + 1])
        elif hi > lo:
            s = _combined(words[lo:hi], hi - lo)
        else:
            s = words[:0]
        fresh = np.ones(len(s), bool)
        np.not_equal(s[1:], s[:-1], out=fresh[1:])
        yield s if fresh.all() else s[fresh]


def shingles(text: bytes | None, n: int = WORDS) -> np.ndarray:
    """Sorted distinct shingle hashes of one text."""
    return next(shingle_sets([text], n))


def class_key(s: np.ndarray) -> bytes:
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest()


def short_key(key: bytes) -> int:
    """64 bits of a class key, for index rows; verification goes by the whole key."""
    return int.from_bytes(key[:8], "little", signed=True)


def may_lack(n: int, percent: int = PERCENT) -> int:
    """Shingles of a set of ``n`` that a linked set may lack."""
    return n - -(-percent * n // 100)


def size_step(n: int) -> int:
    """Steps of a factor 100 / PERCENT: a partner of a set is at most one step smaller."""
    return int(np.floor(np.log(n) / np.log(1.25) + 1e-9))


def classes_of(step: int) -> int:
    """Frequent classes for sets from this step on; far below the smallest overlap of two linked sets."""
    return max(1, int(1.25 ** step) // 6)


def marked(s: np.ndarray, bitmap: np.ndarray) -> np.ndarray:
    """Whether each shingle's bit is set."""
    at = s & np.uint64(64 * len(bitmap) - 1)
    return (bitmap[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) == 1


def signatures(s: np.ndarray, frequent: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """Index keys of one set: rare prefix shingles alone, frequent ones (a mask) as pairs within a class."""
    n = len(s)
    need = may_lack(n, percent) + 1
    rare, freq = s[~frequent], s[frequent]
    if len(rare) >= need:
        return rare[:need]
    out = [rare]
    step = size_step(n)
    for st in {step, max(0, step - 1)}:
        c = classes_of(st)
        kind = (_mix(freq ^ np.uint64(0x5BD1E995)) % np.uint64(c)).astype(np.int64)
        # gain of each further shingle: 0 for the first of its class, else 1
        first = np.zeros(len(freq), bool)
        first[np.unique(kind, return_index=True)[1]] = True
        got = len(rare) + np.cumsum(~first)
        end = int(np.searchsorted(got, need)) + 1  # all of them where the prefix never suffices
        toks, kinds = freq[:end], kind[:end]
        order = np.argsort(kinds, kind="stable")
        toks, kinds = toks[order], kinds[order]
        salt = np.uint64(st + 1)
        for back in range(1, len(toks)):
            same = kinds[back:] == kinds[:-back]
            if not same.any():
                break
            out.append(_mix(_mix(toks[:-back][same] + salt) * np.uint64(31) + toks[back:][same]))
    return np.unique(np.concatenate(out))


def _text_map(docs: DataFrame, extra: list[str], run, schema: str) -> DataFrame:
    flat = docs.select(F.col("text").cast("string").cast("binary").alias("t"), *extra)
    return flat.mapInArrow(run, schema)


def base_table(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """(doc_id, n, key, k, th) per document: set size, class key (null if empty), short key, hash of the text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = list(shingle_sets(b.column(0).to_pylist(), words))
            keys = [class_key(s) if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays(
                [b.column(1), pa.array([len(s) for s in sets], pa.int64()), pa.array(keys, pa.binary()),
                 pa.array([k and short_key(k) for k in keys], pa.int64()), b.column(2)], ["doc_id", "n", "key", "k", "th"])

    flat = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("th"))
    return cut(_text_map(flat, ["doc_id", "th"], run, "doc_id bigint, n bigint, key binary, k bigint, th bigint"),
               "jaccard-base")


def _class_sets(texts: Iterable[bytes | None], seen: set[int], words: int) -> Iterator[tuple[int, np.ndarray]]:
    """(short class key, set) of the texts with words whose class is not in ``seen``, which is kept bounded."""
    for s in shingle_sets(texts, words):
        if not len(s):
            continue
        k = short_key(class_key(s))
        if k in seen:
            continue
        if len(seen) >= 1 << 20:
            seen.clear()
        seen.add(k)
        yield k, s


def shingle_counts(docs: DataFrame, words: int) -> DataFrame:
    """(sig, c): shingles of all texts and how many of a task's classes have them, added up in parts of a task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, held, size = set(), [], 0

        def out() -> Iterator[pa.RecordBatch]:
            sig, c = np.unique(np.concatenate(held), return_counts=True)
            for i in range(0, len(sig), 1 << 17):
                yield pa.RecordBatch.from_arrays([pa.array(sig[i:i + (1 << 17)].view(np.int64)), pa.array(c[i:i + (1 << 17)])],
                                                 ["sig", "c"])
        for b in batches:
            for _, s in _class_sets(b.column(0).to_pylist(), seen, words):
                held.append(s)
                size += len(s)
                if size >= COMPACT_ROWS:
                    yield from out()
                    held, size = [], 0
        if held:
            yield from out()
    return _text_map(docs, [], run, "sig bigint, c bigint")


def frequent_bitmap(docs: DataFrame, words: int) -> np.ndarray:
    """Bits of the shingles that ``FREQUENT`` texts or more have; LABEL_BITS bits whatever the input."""
    none = np.zeros(LABEL_BITS // 64, np.uint64)
    often = shingle_counts(docs, words).groupBy("sig").agg(F.sum("c").alias("c")).filter(F.col("c") >= FREQUENT)
    at = often.select(F.col("sig").bitwiseAND(F.lit(LABEL_BITS - 1)).alias("at"))
    found = cut(at.groupBy(F.shiftright("at", 6).alias("w")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(at & 63 as int))")).alias("m")), "jaccard-labels")
    got = found.toArrow()
    none[got.column(0).to_numpy()] = got.column(1).to_numpy().view(np.uint64)
    discard(found)
    return none


def index_rows(docs: DataFrame, bitmap: np.ndarray, words: int, percent: int) -> DataFrame:
    """(sig, k): index keys of every class, once per task; k is the short class key."""
    sent = docs.sparkSession.sparkContext.broadcast(bitmap)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, seen = sent.value, set()
        for b in batches:
            sigs, keys, held = [], [], 0
            for k, s in _class_sets(b.column(0).to_pylist(), seen, words):
                g = signatures(s, marked(s, bits), percent)
                sigs.append(g)
                keys.append(np.full(len(g), k, np.int64))
                held += len(g)
                if held >= 1 << 18:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(sigs).view(np.int64)),
                                                      pa.array(np.concatenate(keys))], ["sig", "k"])
                    sigs, keys, held = [], [], 0
            if sigs:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(sigs).view(np.int64)),
                                                  pa.array(np.concatenate(keys))], ["sig", "k"])
    return _text_map(docs, [], run, "sig bigint, k bigint")


def sets_of(docs: DataFrame, base: DataFrame, ids: DataFrame, words: int, sketch: bool) -> DataFrame:
    """(k, key, s): shingle set (or its 16-bit sketch) of every class in ``ids`` (k); texts are read again."""
    ids = ids.select(F.col("k").alias("id")).distinct()
    reps = (base.filter("key is not null").join(ids, F.col("k") == F.col("id"), "left_semi")
            .groupBy("key").agg(F.min(F.struct("doc_id", "th")).alias("r"))
            .select(F.col("r.doc_id").alias("rep"), F.col("r.th").alias("rep_th")))
    reps = cut(reps, "jaccard-reps")
    if reps.count() <= BROADCAST_IDS:
        reps = F.broadcast(reps)
    # th is computed once per row here, from the text that is read anyway
    flat = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("th"))
    some = flat.join(reps, (F.col("th") == F.col("rep_th")) & F.col("doc_id").eqNullSafe(F.col("rep")), "left_semi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for s in shingle_sets(b.column(0).to_pylist(), words):
                if len(s):
                    out.append((class_key(s), (s >> np.uint64(48)).astype("<u2").tobytes() if sketch else s.tobytes()))
            for i in range(0, len(out), 256):
                part = out[i:i + 256]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([short_key(k) for k, _ in part], pa.int64()), pa.array([k for k, _ in part], pa.binary()),
                     pa.array([s for _, s in part], pa.binary())], ["k", "key", "s"])
    got = cut(_text_map(some, [], run, "k bigint, key binary, s binary"), "jaccard-sets")
    # identical rows give the same set; only then is there anything to drop
    n = got.agg(F.count("key"), F.count_distinct("key")).first()
    return got if n[0] == n[1] else cut(got.dropDuplicates(["key"]), "jaccard-sets")


def overlap(x: np.ndarray, y: np.ndarray) -> int:
    """Common elements of two sorted arrays, repeats counted."""
    if len(x) > len(y):
        x, y = y, x
    first = np.searchsorted(x, x)
    rank = np.arange(len(x)) - first  # of an element among its equals
    lo, hi = np.searchsorted(y, x), np.searchsorted(y, x, "right")
    return int((rank < hi - lo).sum())


def _checked(pairs: DataFrame, sets: DataFrame, percent: int, dtype, keep: str) -> DataFrame:
    """The rows of ``pairs`` (a, b) whose sets (or sketches) overlap enough: as short keys, or as class keys (u, v)."""
    left = sets.select(F.col("k").alias("ka"), F.col("key").alias("u"), F.col("s").alias("sa"))
    right = sets.select(F.col("k").alias("kb"), F.col("key").alias("v"), F.col("s").alias("sb"))
    both = pairs.join(left, F.col("a") == F.col("ka")).join(right, F.col("b") == F.col("kb"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            good = []
            for i, (x, y) in enumerate(zip(b.column(2), b.column(3))):
                x, y = np.frombuffer(x.as_buffer(), dtype), np.frombuffer(y.as_buffer(), dtype)
                common = overlap(x, y)
                if 100 * common >= percent * (len(x) + len(y) - common):
                    good.append(i)
            if good:
                yield b.select([0, 1]).take(pa.array(good))
    names = keep.split()
    kind = both.schema[names[0]].dataType.simpleString()
    return both.select(*names, "sa", "sb").mapInArrow(run, f"{names[0]} {kind}, {names[1]} {kind}")


def block_links(left: list[np.ndarray], right: list[np.ndarray], percent: int) -> np.ndarray:
    """Boolean matrix: which sets of ``left`` link with which of ``right`` (sorted distinct arrays)."""
    n, m = len(left), len(right)
    sizes = np.array([len(s) for s in left], np.int64), np.array([len(s) for s in right], np.int64)
    values, at = np.unique(np.concatenate([*left, *right]), return_inverse=True)
    row = np.repeat(np.arange(n + m), np.concatenate(sizes))
    # only values of both sides count
    both = (np.bincount(at[row < n], minlength=len(values)) > 0) & (np.bincount(at[row >= n], minlength=len(values)) > 0)
    column = np.cumsum(both) - 1
    hit = both[at]
    at, row = column[at[hit]], row[hit]
    order = np.argsort(at, kind="stable")
    at, row = at[order], row[order]
    common = np.zeros((n, m), np.float64)
    for low in range(0, int(both.sum()), SLICE):
        lo, hi = np.searchsorted(at, [low, low + SLICE])
        ones = np.zeros((n + m, SLICE), np.float32)
        ones[row[lo:hi], at[lo:hi] - low] = 1
        common += ones[:n] @ ones[n:].T  # exact: below 2^24 in a slice
    return 100 * common >= percent * (sizes[0][:, None] + sizes[1][None, :] - common)


def forest(us: np.ndarray, vs: np.ndarray, roots: list) -> list[int]:
    """Positions of the links (us, vs) that join two groups not yet joined; rows of one root start joined."""
    of = {r: i for i, r in enumerate(dict.fromkeys(roots))}
    parent = list(range(len(of)))

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    kept = []
    for i, (u, v) in enumerate(zip(us.tolist(), vs.tolist())):
        x, y = find(of[roots[u]]), find(of[roots[v]])
        if x != y:
            parent[x] = y
            kept.append(i)
    return kept


def common_values(x: np.ndarray, y: np.ndarray) -> int:
    """Common elements of two sorted arrays without repeats."""
    if len(x) > len(y):
        x, y = y, x
    at = np.searchsorted(y, x)
    at[at == len(y)] = 0
    return int((y[at] == x).sum())


def pair_links(data: list[np.ndarray], pairs: Iterable[tuple[int, int]], percent: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``pairs`` of positions whose sets (sorted, without repeats) link; sizes too far apart end at once."""
    us, vs = [], []
    for u, v in pairs:
        n, m = len(data[u]), len(data[v])
        if 100 * min(n, m) >= percent * max(n, m):
            common = common_values(data[u], data[v])
            if 100 * common >= percent * (n + m - common):
                us.append(u)
                vs.append(v)
    return np.array(us, np.int64), np.array(vs, np.int64)


def told_apart(sketch: np.ndarray) -> np.ndarray:
    """A sorted sketch as distinct values: the value and its rank among its equals."""
    return sketch.astype(np.uint64) + ((np.arange(len(sketch)) - np.searchsorted(sketch, sketch)).astype(np.uint64) << np.uint64(16))


def _block_pairs(members: DataFrame, sets: DataFrame, run, schema: str) -> DataFrame:
    """``run`` on every pair of blocks of every group of ``members`` (lead, g, k, n, ...), with key and s.

    A group of several blocks is one call per pair of blocks; a call gets two blocks at most.
    """
    kept = [c for c in members.columns if c not in ("lead", "g", "k", "n")]
    parts = members.groupBy("lead", "g").agg(F.greatest(
        F.ceil(F.count(F.lit(1)) / BLOCK_SETS), F.ceil(F.sum("n") / BLOCK_SHINGLES)).cast("int").alias("parts"))
    dealt = members.join(parts, ["lead", "g"]).withColumn("block", F.pmod(F.xxhash64("k"), F.col("parts")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.expr("sequence(0, parts - 1)"))).select(
        "lead", "g", "k", "block", *kept, F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))
    rows = dealt.join(sets.select(F.col("k").alias("ks"), "key", "s"), F.col("k") == F.col("ks")).drop("ks")
    return rows.groupBy("lead", "g", "i", "j").applyInArrow(run, schema)


def _linked(table: pa.Table, dtype, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions (us, vs) of the rows of two blocks whose sets (or sketches) overlap enough; no row with itself."""
    i, j = table.column("i")[0].as_py(), table.column("j")[0].as_py()
    block = table.column("block").to_numpy()
    left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
    if not len(left) or not len(right):
        return left[:0], right[:0]
    data = [np.frombuffer(x.as_buffer(), dtype) for x in table.column("s").combine_chunks()]
    if dtype != np.uint64:
        data = [told_apart(x) for x in data]
    if len(left) * len(right) <= FEW_PAIRS:
        return pair_links(data, combinations(left, 2) if i == j else product(left, right), percent)
    us, vs = np.nonzero(block_links([data[x] for x in left], [data[x] for x in right], percent))
    us, vs = left[us], right[vs]
    return us[us != vs], vs[us != vs]


def with_partner(members: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """The ``members`` (lead, g, k, n) whose sketch overlaps enough with another's of their group."""
    def run(table: pa.Table) -> pa.Table:
        return table.select(["lead", "g", "k"]).take(pa.array(np.unique(np.concatenate(_linked(table, "<u2", percent)))))

    found = _block_pairs(members, sketches, run, "lead bigint, g bigint, k bigint").distinct()
    return cut(members.join(found, ["lead", "g", "k"], "left_semi"), "jaccard-members")


def cluster_links(open_: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(u, v) links that join components inside a group; ``open_`` is (lead, g, k, n, root)."""
    def run(table: pa.Table) -> pa.Table:
        roots, keys = table.column("root").to_pylist(), table.column("key").to_pylist()
        us, vs = _linked(table, np.uint64, percent)
        good = forest(us, vs, roots)
        return pa.table({"u": pa.array([keys[us[x]] for x in good], pa.binary()),
                         "v": pa.array([keys[vs[x]] for x in good], pa.binary())})

    return cut(_block_pairs(open_, sets, run, "u binary, v binary"), "jaccard-links")


def _pairs(df: DataFrame, a: str, b: str) -> DataFrame:
    return df.filter(F.col(a) != F.col(b)).select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).distinct()


def class_links(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """(base, roots): the base table, and (node, root) for every class that links with another.

    The links behind the roots connect exactly what all links connect.
    """
    base = base_table(docs, words)
    rows = cut(index_rows(docs, frequent_bitmap(docs, words), words, percent), "jaccard-rows")
    heads = (rows.groupBy("sig").agg(F.min("k").alias("lead"), F.max("k").alias("last"))
             .filter("lead != last").select(F.col("sig").alias("of"), "lead"))
    # keys with one class end here
    multi = cut(rows.join(heads, F.col("sig") == F.col("of")).select("lead", "k").distinct(), "jaccard-index")
    discard(rows)
    size = base.filter("key is not null").select(F.col("k").alias("kn"), "n").distinct()
    pairs = _pairs(multi, "lead", "k")
    sized = (pairs.join(size.toDF("ka", "na"), F.col("a") == F.col("ka")).join(size.toDF("kb", "nb"), F.col("b") == F.col("kb"))
             .filter(100 * F.least("na", "nb") >= percent * F.greatest("na", "nb")).select("a", "b"))
    sized = cut(sized, "jaccard-sized")
    members = cut(size_groups(multi.filter("lead != k").join(size, F.col("k") == F.col("kn")), percent), "jaccard-members")
    ids = sized.select(F.col("a").alias("k")).unionAll(sized.select("b")).unionAll(members.select("k"))
    sketches = sets_of(docs, base, ids, words, True)
    near = cut(_checked(sized, sketches, percent, "<u2", "a b").distinct(), "jaccard-near")
    dealt, members = members, with_partner(members, sketches, percent)
    discard(sketches, multi, dealt)
    ids = near.select(F.col("a").alias("k")).unionAll(near.select("b")).unionAll(members.select("k"))
    sets = sets_of(docs, base, ids, words, False)
    links = cut(_checked(near, sets, percent, np.uint64, "u v"), "jaccard-links")
    open_ = _labelled(members, base, components(links))
    several = open_.groupBy("lead", "g").agg(F.min("root").alias("r0"), F.max("root").alias("r1")).filter("r0 != r1")
    open_ = cut(open_.join(several, ["lead", "g"], "left_semi"), "jaccard-open")
    links = links.unionAll(cluster_links(open_, sets, percent))
    discard(sets, members, open_)
    return base, components(links)


def size_groups(members: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(lead, g, k, n): members of a cluster dealt by size; two of similar enough sizes share a group g.

    Group g holds the sizes of steps g - 1 and g; groups without a pair, or with step g - 1 only, are left out.
    """
    step = F.floor(F.log("n") / F.lit(float(np.log(100 / percent))) + 1e-9)
    dealt = members.select("lead", "k", "n", step.alias("st")).select(
        "lead", "k", "n", "st", F.explode(F.array(F.col("st"), F.col("st") + 1)).alias("g"))
    some = dealt.groupBy("lead", "g").agg(F.count(F.lit(1)).alias("c"), F.max("st").alias("top")).filter("c > 1 and top = g")
    return dealt.join(some, ["lead", "g"], "left_semi").select("lead", "g", "k", "n")


def _labelled(members: DataFrame, base: DataFrame, roots: DataFrame) -> DataFrame:
    """``members`` with the root of each class; a class without links is its own root."""
    of = base.filter("key is not null").select("k", "key").distinct().join(roots, F.col("key") == F.col("node"), "left").select(
        F.col("k").alias("k1"), F.coalesce("root", "key").alias("root"))
    return members.join(of, F.col("k") == F.col("k1")).select("lead", "g", "k", "n", "root")


def jaccard_components(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """(doc_id, th, n_shingles, class_key, component_id) per document."""
    base, roots = class_links(docs, words, percent)
    named = base.join(roots, F.col("key") == F.col("node"), "left").withColumn("root", F.coalesce("root", "key"))
    named = cut(named.select("doc_id", "th", "n", "key", "root"), "jaccard-named")
    low = named.filter("key is not null").groupBy("root").agg(F.min("doc_id").alias("low"))
    out = named.join(low.withColumnRenamed("root", "of"), F.col("root") == F.col("of"), "left")
    return out.select("doc_id", "th", F.col("n").alias("n_shingles"), F.col("key").alias("class_key"), "root",
                      F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("low")).alias("component_id"))


def keep_one(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """``docs`` with one document of each component: that of the smallest (doc_id, text hash).

    Documents with an empty set all stay. Of fully equal rows one stays.
    """
    cols = docs.columns
    inner = docs.toDF(*[f"c{i}" for i in range(len(cols))])
    doc_id, text = F.col(f"c{cols.index('doc_id')}"), F.col(f"c{cols.index('text')}")
    got = jaccard_components(docs.select("doc_id", "text"), words, percent)
    rep = got.filter("class_key is not null").groupBy("root").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("z"), "doc_id", "th")).alias("r"))
    rep = rep.select(F.col("r.doc_id").alias("rep"), F.col("r.th").alias("rep_th"))
    many = got.filter("class_key is not null").groupBy("doc_id", "th").agg(F.count(F.lit(1)).alias("rows"))
    rep = cut(rep.join(many, (F.col("th") == F.col("rep_th")) & F.col("doc_id").eqNullSafe(F.col("rep")))
              .select("rep", "rep_th", "rows"), "jaccard-kept")
    side = F.broadcast(rep) if rep.count() <= BROADCAST_IDS else rep
    empty = ~F.coalesce(text.rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    on = (F.xxhash64(text) == F.col("rep_th")) & doc_id.eqNullSafe(F.col("rep"))
    kept = inner.filter(~empty).join(side, on)
    once = kept.filter("rows = 1").select(*inner.columns)
    # rows that share id and text (few): one of them stays, chosen by the rest of the row
    again = kept.filter("rows > 1").select("rep", "rep_th", *inner.columns)
    pick = again.groupBy("rep", "rep_th").agg(F.min(F.struct(*inner.columns)).alias("r")).select("r.*")
    return once.unionAll(pick).unionAll(inner.filter(empty)).toDF(*cols)


def op8_jaccard_join(spark, sf_dir):
    """Components of all documents under links of 0.8 and more."""
    got = jaccard_components(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return got.select("doc_id", "n_shingles", "component_id")
