"""Exact removal of repeated strings by distributed prefix doubling over sparse positions.

Every byte covered by a string of ``length`` bytes that also starts anywhere
else is removed. Sorting the suffixes of all byte positions would move many
times the input, so ranks are kept for content-defined positions only, and
every step drops what is unique:

1. Equal texts are one text with a number of copies. Anchors are the window
   minima of a hash of ``GRAM`` bytes (rightmost on a tie), so equal strings
   have equal anchors inside. The bytes from one anchor to the end of the next
   one are a phrase; text ends are anchors too. Phrases have 128-bit names.
2. Names, then pairs of ranks (i, i + 2^t) at offsets 1, 2, 4 ... phrases, are
   counted; the repeated ones are numbered, and the number is the
   rank of the next round. Unique pairs are dropped; a position stops when its
   string is past the length looked for. Rounds work on ranks alone, never on
   text, and a rank stands for one pair only: hashes enter in round 0 alone.
   The ranks of a level are packed per text, so a round sorts by text alone.
3. All start bytes p with the same phrases around [p, p + length) form a
   class. The two overlapping ranks that span these phrases and their number
   name it; where that occurs again, all starts of the class are repeated.
4. The starts left open lie at the ends of a repeat: those whose inner
   phrases are repeated, by the same ranks, though the outer ones are not.
   Blocks of them are named by the bytes that their strings share and by those
   they cover; where the latter repeat, the whole block does. Starts of blocks
   that only share repeated bytes are named by their own ``length`` bytes (128 bits); so is
   one example of every repeated class with the same inner bytes as an open start.

Names are counted by partial aggregation and joined back, so a passage with a
third of all rows is neither one task nor a list of pairs. The distinct names
of a shuffled partition must fit a task's memory when they are joined back. Names are two polynomial hashes of 64 bits each; a
wrong removal takes a collision in both, of which n named strings have
n^2 / 2^129 in expectation.

Defined cases: a null text is empty; texts shorter than ``length`` lose
nothing; repeated rows are copies of each other; overlapping occurrences in
one text count; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import cut, discard, read_table

LENGTH = 400
GRAM = 32
WINDOW = 112
#: starts of an open range are looked up by blocks of so many before they are named one by one
BLOCK = 16
#: bytes, and phrases, of several texts that are worked on together, so that short texts share the numpy calls
BYTES, PHRASES = 1 << 16, 1 << 15
NO_ANCHOR = 255
_B1, _B2 = 0x9E3779B97F4A7C15, 0xD1342543DE82EF95
_INV1, _INV2 = pow(_B1, -1, 1 << 64), pow(_B2, -1, 1 << 64)
_BYTE = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class _Powers:
    """Powers of a base and of its inverse (mod 2^64), grown on demand."""

    def __init__(self) -> None:
        self.n = 0

    def upto(self, n: int):
        if n > self.n:
            self.n = max(n, 2 * self.n, 1 << 16)
            self.tables = [np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(self.n, b, np.uint64))])
                           for b in (_B1, _B2, _INV1, _INV2)]
        return self.tables


_powers = _Powers()


class Text:
    """Substring names of one text."""

    def __init__(self, raw: bytes) -> None:
        c = _BYTE[np.frombuffer(raw, np.uint8)]
        self.n = n = len(c)
        p1, p2, self.i1, self.i2 = _powers.upto(n)
        self.h1, self.h2 = np.zeros(n + 1, np.uint64), np.zeros(n + 1, np.uint64)
        np.cumsum(c * p1[:n], out=self.h1[1:])
        np.cumsum(c * p2[:n], out=self.h2[1:])

    def name(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        a = (self.h1[end] - self.h1[start]) * self.i1[start]
        b = (self.h2[end] - self.h2[start]) * self.i2[start]
        return _mix(a + _mix(b + (end - start).astype(np.uint64)))

    def names(self, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Two independent hashes of the strings [start, end), as signed longs."""
        n = (end - start).astype(np.uint64)
        a = (self.h1[end] - self.h1[start]) * self.i1[start]
        b = (self.h2[end] - self.h2[start]) * self.i2[start]
        return _mix(a + n).view(np.int64), _mix(b + _mix(n)).view(np.int64)

    def minima(self, gram: int = GRAM, window: int = WINDOW) -> np.ndarray:
        """For every window of ``window`` grams the position of its smallest gram hash, rightmost on a tie."""
        m = self.n - gram + 1
        at = np.arange(m)
        h = _mix((self.h1[gram:] - self.h1[:m]) * self.i1[:m])
        # hash above, position (reversed) below: the minimum is the rightmost smallest
        v = (h & np.uint64(0xFFFFFFFF00000000)) | (np.uint64(0xFFFFFFFF) - at.astype(np.uint64))
        size = 1
        while 2 * size <= window:
            v = np.minimum(v[:-size], v[size:])
            size *= 2
        if size < window:
            v = np.minimum(v[:len(v) - (window - size)], v[window - size:])
        return (np.uint64(0xFFFFFFFF) - (v & np.uint64(0xFFFFFFFF))).astype(np.int64)

    def phrases(self, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(starts, ends, lead) of the phrases of the texts [off[d], off[d + 1]) that lie here one after the other.

        The first phrase of a text starts with it, the last one ends with it.
        ``lead``: how far before the anchor the first window lies that has it
        as its minimum; ``NO_ANCHOR`` for a text's start that is none.
        """
        least = self.minima()
        new = np.zeros(len(least), bool)
        new[1:] = least[1:] != least[:-1]
        new[off[:-1]] = True
        at = np.flatnonzero(new)
        at = at[at + GRAM + WINDOW - 1 <= off[np.searchsorted(off, at, "right")]]
        starts, plain = least[at], off[:-1][least[off[:-1]] != off[:-1]]
        lead, where = (starts - at).astype(np.uint8), np.searchsorted(starts, plain)
        starts, lead = np.insert(starts, where, plain), np.insert(lead, where, NO_ANCHOR)
        ends = np.minimum(np.append(starts[1:], self.n) + GRAM, off[np.searchsorted(off, starts, "right")])
        return starts, ends, lead


def _key():
    """SHA-256 of the text: equal texts are one."""
    return F.sha2(_bytes(), 256)


def _bytes():
    return F.col("text").cast("string").cast("binary")


def _long_texts(docs: DataFrame, length: int) -> DataFrame:
    """(k, t) of the rows whose text can hold the string."""
    return docs.select(_bytes().alias("t"), _key().alias("k")).filter(F.octet_length("t") >= length)


def _chunks(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*rows)], names)


def _per_doc(col: pa.Array) -> tuple[np.ndarray, list[np.ndarray]]:
    """Offsets and the flattened numpy fields of a list<struct> column."""
    off = col.offsets.to_numpy()
    values = col.values
    return off, [values.field(k).to_numpy(zero_copy_only=False) for k in range(values.type.num_fields)]


def _groups(size: np.ndarray, most: int) -> Iterator[slice]:
    """Slices of the rows, each of one row or of ``most`` in size together."""
    ends, i = np.cumsum(size), 0
    while i < len(size):
        j = max(i + 1, int(np.searchsorted(ends, most + (ends[i - 1] if i else 0), "right")))
        yield slice(i, j)
        i = j


def _packed(values: np.ndarray, count: np.ndarray) -> pa.Array:
    """One binary per row, of ``count`` entries of ``values`` each."""
    width = values.itemsize * (values.shape[1] if values.ndim > 1 else 1)
    off = np.concatenate([[0], np.cumsum(count) * width]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(count), [None, pa.py_buffer(off), pa.py_buffer(np.ascontiguousarray(values))])


def _counts(column: list[bytes], width: int) -> np.ndarray:
    return np.fromiter(map(len, column), np.int64, len(column)) // width


def signatures(docs: DataFrame, length: int) -> DataFrame:
    """(sid, k, w, n, steps, lead, xy) of every different text: w its copies (1, or 2 for more), n its bytes.

    ``steps`` holds the distances between phrase starts (int32), ``lead`` see
    ``Text.phrases`` (uint8), ``xy`` the names of the phrases (two int64 each).
    ``sid`` is given once, on writing.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw, out = b.column(0).to_pylist(), []
            n = _counts(raw, 1)
            for g in _groups(n, BYTES):
                t = Text(b"".join(raw[g]))
                off = np.concatenate([[0], np.cumsum(n[g])])
                s, e, lead = t.phrases(off)
                first = np.searchsorted(s, off)
                steps = np.diff(s, prepend=0).astype(np.int32)
                steps[first[:-1]] = 0
                out.append((np.diff(first), steps, lead, np.stack(t.names(s, e), 1)))
            if out:
                count, *parts = (np.concatenate(c) for c in zip(*out))
                yield pa.RecordBatch.from_arrays([b.column(1), pa.array(n.astype(np.int32)), *(_packed(c, count) for c in parts)],
                                                 ["k", "n", "steps", "lead", "xy"])
    rows = _long_texts(docs, length).mapInArrow(run, "k string, n int, steps binary, lead binary, xy binary")
    one = rows.groupBy("k").agg(F.count(F.lit(1)).alias("c"), *[F.first(c).alias(c) for c in ("n", "steps", "lead", "xy")])
    return cut(one.select(F.monotonically_increasing_id().alias("sid"), "k", F.least("c", F.lit(2)).cast("byte").alias("w"),
                          "n", "steps", "lead", "xy"), "suffix-texts")


def phrase_rows(sigs: DataFrame, length: int) -> DataFrame:
    """(x, y, sid, i, reach, w) of every phrase.

    ``reach`` is the greatest number of phrases from i on that one string of
    ``length`` can touch: the last of them starts less than ``length`` behind the second.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sid, w = (b.column(c).to_numpy(zero_copy_only=False) for c in (0, 1))
            steps, xy = b.column(2).to_pylist(), b.column(3).to_pylist()
            count = _counts(steps, 4)
            for g in _groups(count, 4 * PHRASES):
                c = count[g]
                ends = np.cumsum(c)
                step = np.frombuffer(b"".join(steps[g]), np.int32).astype(np.int64)
                step[ends[:-1]] = length  # the texts lie so far apart that none reaches the next
                s, i = np.cumsum(step), np.arange(len(step))
                reach = np.ones(len(s), np.int64)
                reach[:-1] = np.searchsorted(s, s[1:] + length) - i[:-1]
                reach[ends - 1] = 1
                name = np.frombuffer(b"".join(xy[g]), np.int64).reshape(-1, 2)
                yield _chunks([(name[:, 0], name[:, 1], np.repeat(sid[g], c), (i - np.repeat(ends - c, c)).astype(np.int32),
                                reach.astype(np.int32), np.repeat(w[g], c))], ["x", "y", "sid", "i", "reach", "w"])
    return sigs.select("sid", "w", "steps", "xy").mapInArrow(run, "x bigint, y bigint, sid bigint, i int, reach int, w byte")


def twice(rows: DataFrame, *name: str) -> DataFrame:
    """The names that occur twice or more, copies counted; collapsed map-side. Columns are the names with an ``r`` before."""
    return (rows.groupBy(*name).agg(F.sum("w").alias("c")).filter("c > 1")
            .select(*[F.col(c).alias(f"r{c}") for c in name]))


def repeated(rows: DataFrame, names: DataFrame, *name: str) -> DataFrame:
    """The rows whose name is in ``names`` (see ``twice``): joined, not grouped.

    The names are distinct and the smaller side, so they are the hash table
    of a shuffled partition; the rows are not sorted, and those of a hot name may be split.
    """
    on = [F.col(c) == F.col(f"r{c}") for c in name]
    return rows.join(names.hint("shuffle_hash"), on).drop(*[f"r{c}" for c in name])


def pair_ranks(rows: DataFrame) -> DataFrame:
    """(rx, ry, rank): the repeated pairs (x, y), numbered once, on writing."""
    return cut(twice(rows, "x", "y").withColumn("rank", F.monotonically_increasing_id()), "suffix-ranks")


def ranked(rows: DataFrame, ranks: DataFrame) -> DataFrame:
    """(sid, i, reach, w, rank) of the rows whose pair is in ``ranks``."""
    return repeated(rows, ranks, "x", "y").select("sid", "i", "reach", "w", "rank")


def rerank(rows: DataFrame) -> DataFrame:
    """(sid, i, reach, w, rank) of the rows whose pair (x, y) is repeated; the rank is the number of the pair."""
    return ranked(rows, pair_ranks(rows))


def by_text(level: DataFrame) -> DataFrame:
    """(sid, w, i, reach, rank) of every text: its rows of ``level`` by i, packed (int32, int32, int64).

    Spark sorts by ``sid`` alone, the numbers of one text are put in order here. i, reach and w travel as one number.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for b in batches:
            if not b.num_rows:
                continue
            cols = [c.to_numpy(zero_copy_only=False) for c in b.columns]
            first = np.flatnonzero(np.diff(cols[0], prepend=cols[0][0]))
            if held and cols[0][0] != held[-1][0][-1]:
                yield packed(held)
                held = []
            # the last text of the batch may go on in the next one
            if len(first):
                yield packed([*held, [c[:first[-1]] for c in cols]])
                held = []
            held.append([c[first[-1] if len(first) else 0:] for c in cols])
        if held:
            yield packed(held)

    def packed(parts: list[list[np.ndarray]]) -> pa.RecordBatch:
        sid, v, rank = (np.concatenate(c) for c in zip(*parts))
        first = np.flatnonzero(np.diff(sid, prepend=sid[0] - 1))
        count = np.diff(np.append(first, len(sid)))
        order = np.lexsort((v, np.repeat(np.arange(len(first)), count)))
        i, reach = (v[order] >> 32).astype(np.int32), ((v[order] & 0xFFFFFFFF) >> 2).astype(np.int32)
        return pa.RecordBatch.from_arrays([pa.array(sid[first]), pa.array((v[first] & 3).astype(np.int8)), _packed(i, count),
                                           _packed(reach, count), _packed(rank[order], count)], ["sid", "w", "i", "reach", "rank"])

    v = F.expr("shiftleft(bigint(i), 32) | shiftleft(bigint(reach), 2) | w").alias("v")
    rows = level.select("sid", v, "rank").repartition("sid").sortWithinPartitions("sid")
    return rows.mapInArrow(run, "sid bigint, w byte, i binary, reach binary, rank binary")


def pairs(texts: DataFrame, step: int) -> DataFrame:
    """Rank pairs (x, y) of i and i + step in the rows of ``by_text``, where one string can touch all 2 * step phrases."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sid, w = (b.column(c).to_numpy(zero_copy_only=False) for c in (0, 1))
            packed = [b.column(c).to_pylist() for c in (2, 3, 4)]
            count = _counts(packed[0], 4)
            for g in _groups(count, 4 * PHRASES):
                i, reach, rank = (np.frombuffer(b"".join(c[g]), t) for c, t in zip(packed, (np.int32, np.int32, np.int64)))
                doc = np.repeat(np.arange(g.start, g.stop), count[g])
                key = doc << 32 | i
                at = np.minimum(np.searchsorted(key, key + step), len(key) - 1)
                of = np.flatnonzero((key[at] == key + step) & (reach >= 2 * step))
                yield _chunks([(rank[of], rank[at[of]], sid[doc[of]], i[of], reach[of], w[doc[of]])],
                              ["x", "y", "sid", "i", "reach", "w"])
    return texts.mapInArrow(run, "x bigint, y bigint, sid bigint, i int, reach int, w byte")


def double(level: DataFrame, step: int) -> DataFrame:
    """Rank pairs (x, y) of i and i + step, see ``pairs``."""
    return pairs(by_text(level), step)


def levels(sigs: DataFrame, length: int) -> DataFrame:
    """(sid, k, w, n, steps, lead, m): m the (t, i, rank) of every level t of a text, its repeated rank pairs packed by i."""
    rows, step, found = phrase_rows(sigs, length), 1, []
    while True:
        ranks = pair_ranks(rows)
        texts = cut(by_text(ranked(rows, ranks)), "suffix-level")
        discard(ranks)
        if found:
            discard(rows)
        found.append(texts)
        if not texts.take(1):
            break
        rows = cut(pairs(texts, step), "suffix-pairs")
        step *= 2
    all_levels = None
    for t, x in enumerate(found):
        x = x.select(F.col("sid").alias("msid"), F.struct(F.lit(t).alias("t"), "i", "rank").alias("e"))
        all_levels = x if all_levels is None else all_levels.unionByName(x)
    marks = all_levels.groupBy("msid").agg(F.collect_list("e").alias("m"))
    out = cut(sigs.join(marks, F.col("sid") == F.col("msid")).select("sid", "k", "w", "n", "steps", "lead", "m"), "suffix-marks")
    discard(*found)
    return out


class Line:
    """Phrases and repeated ranks of several texts on one line, ``length`` bytes from one text to the next."""

    def __init__(self, n: np.ndarray, steps: list[bytes], marks: pa.Array, length: int) -> None:
        self.count = _counts(steps, 4)
        self.base = np.concatenate([[0], np.cumsum(n.astype(np.int64) + length)])
        self.first = np.concatenate([[0], np.cumsum(self.count)])
        at = np.cumsum(np.frombuffer(b"".join(steps), np.int32), dtype=np.int64)
        self.start = at + np.repeat(self.base[:-1] - at[self.first[:-1]], self.count)
        self.end = np.minimum(np.append(self.start[1:], self.base[-1]) + GRAM, np.repeat(self.base[1:] - length, self.count))
        entries = marks.flatten()
        t, i, rank = (entries.field(c).to_numpy(zero_copy_only=False) for c in range(3))
        doc = np.repeat(np.arange(len(n)), np.diff(marks.offsets.to_numpy()))
        order = np.lexsort((t, doc))
        count = _counts(i[order], 4)
        doc, t = (np.repeat(c[order].astype(np.int64), count) for c in (doc, t))
        i = np.frombuffer(b"".join(i[order]), np.int32)
        # text, level and phrase number: ascending, each once
        self.key, self.rank = doc << 38 | t << 32 | i, np.frombuffer(b"".join(rank[order]), np.int64)
        self.of = doc[t == 0]
        self.repeated = i[t == 0] + self.first[self.of]

    def doc(self, at: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.base, at, "right") - 1

    def span(self, doc: np.ndarray, left: np.ndarray, m: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ok, x, y): whether the overlapping ranks that span ``m`` phrases from ``left`` on are repeated, and the two."""
        t = np.floor(np.log2(m) + 1e-12).astype(np.int64)
        out = []
        for i in (left, left + m - (1 << t)):
            k = doc << 38 | t << 32 | (i - self.first[doc])
            a = np.minimum(np.searchsorted(self.key, k), len(self.key) - 1)
            out.append((self.key[a] == k, self.rank[a]))
        return out[0][0] & out[1][0], out[0][1], out[1][1]


def class_rows(marks: DataFrame, length: int) -> DataFrame:
    """(x, y, z, sid, lo, hi, w): the classes of starts whose phrases around are all repeated, named by two ranks and a number."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sid, w, n = (b.column(c).to_numpy(zero_copy_only=False) for c in range(3))
            steps = b.column(3).to_pylist()
            for g in _groups(_counts(steps, 4), PHRASES):
                doc, x, y, z, lo, hi = _classes(Line(n[g], steps[g], b.column(4).slice(g.start, g.stop - g.start), length), length)
                yield _chunks([(x, y, z.astype(np.int32), sid[g][doc], lo.astype(np.int32), hi.astype(np.int32), w[g][doc])],
                              ["x", "y", "z", "sid", "lo", "hi", "w"])
    return marks.select("sid", "w", "n", "steps", "m").mapInArrow(
        run, "x bigint, y bigint, z int, sid bigint, lo int, hi int, w byte")


def _classes(line: Line, length: int) -> tuple[np.ndarray, ...]:
    """(doc, x, y, z, lo, hi) of the classes, from every stretch of repeated phrases that holds a string."""
    x = line.repeated
    b, e = line.start[x], line.end[x]
    new = np.flatnonzero((np.diff(x) != 1) | (np.diff(line.of) != 0)) + 1
    s0, s1 = np.concatenate([[0], new]), np.concatenate([new, [len(x)]])
    lo, hi = b[s0], e[s1 - 1] - length
    # stretches follow each other: one with a string ends before the next one begins
    cuts, of = np.concatenate([b, e - (length - 1)]), np.tile(np.repeat(np.arange(len(s0)), s1 - s0), 2)
    cuts = np.unique(np.concatenate([lo[hi >= lo], cuts[(cuts > lo[of]) & (cuts <= hi[of])]]))
    left = x[np.searchsorted(b, cuts, "right") - 1]
    right = x[np.searchsorted(e, cuts + length, "left")]
    of = np.searchsorted(lo, cuts, "right") - 1
    last = np.minimum(np.append(cuts[1:] - 1, line.base[-1]), hi[of])
    m, doc = right - left + 1, line.doc(cuts)
    # the two ranks fix the bytes; the start within them does not matter for a whole class
    ok, r1, r2 = line.span(doc, left, m)
    return tuple(c[ok] for c in (doc, r1, r2, m, cuts - line.base[doc], last - line.base[doc]))


def _ranges_of(line: Line, lead: np.ndarray, n: np.ndarray, lo, hi, example, length: int) -> tuple[np.ndarray, ...]:
    """(doc, key, inner, open, lo, hi): ranges of starts whose inner phrases are repeated.

    Their ranks name them (key); the starts have the same phrases inside, from
    ``inner`` on. Starts of the repeated classes (lo, hi, on the line) are
    left out but for the classes' examples; open ones are one range whatever lies around.
    """
    anchors = np.flatnonzero(lead != NO_ANCHOR)
    seen = line.start[anchors] - lead[anchors]  # the first window with this minimum
    # phrase boundaries that every occurrence of the string shares: from its first window's minimum to its last one's
    far = length - GRAM + 1 - WINDOW
    order = np.argsort(lo)
    lo, hi, example = lo[order], hi[order], example[order]
    p = np.unique(np.concatenate([seen, seen - far, lo, hi + 1]))
    p = p[p >= 0]
    doc = line.doc(p)
    keep = p - line.base[doc] <= n[doc] - length
    p, doc = p[keep], doc[keep]
    held = np.searchsorted(lo, p, "right") - 1  # the class that may hold the start
    if len(lo):
        held[(held >= 0) & (hi[held] < p)] = -1
    r0 = anchors[np.searchsorted(seen, p, "right") - 1]
    r1 = anchors[np.searchsorted(seen, p + far, "right") - 1]
    ok, x, y = line.span(doc, r0, r1 - r0)
    edge = np.ones(len(p), bool)
    edge[1:] = False
    for k in (doc, ok, held, r0, r1):
        edge[1:] |= k[1:] != k[:-1]
    end = np.minimum(np.append(p[edge][1:] - 1, line.base[-1]), (line.base[:-1] + n - length)[doc[edge]])
    p, doc, ok, held, r0, r1, x, y = (c[edge] for c in (p, doc, ok, held, r0, r1, x, y))
    if len(lo):
        ok &= (held < 0) | example[held]
    p, end, doc, held, r0, r1, x, y = (c[ok] for c in (p, end, doc, held, r0, r1, x, y))
    m = _mix((r1 - r0).astype(np.uint64))
    key = _mix(x.astype(np.uint64) + _mix(y.astype(np.uint64) + m)).view(np.int64)
    base = line.base[doc]
    return doc, key, line.start[r0] - base, held < 0, p - base, end - base


def open_classes(found: DataFrame, length: int) -> DataFrame:
    """(key, inner, open, sid, lo, hi, w): see ``_ranges_of``, of all texts with repeated phrases; no text is read.

    An example stands for a class at two places, so its ``w`` is 2.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sid, w, n = (b.column(c).to_numpy(zero_copy_only=False) for c in range(3))
            steps, lead = (b.column(c).to_pylist() for c in (3, 4))
            off, (lo, hi, example) = _per_doc(b.column(6))
            for g in _groups(_counts(steps, 4), PHRASES):
                line = Line(n[g], steps[g], b.column(5).slice(g.start, g.stop - g.start), length)
                sure = slice(off[g.start], off[g.stop])
                base = np.repeat(line.base[:-1], np.diff(off[g.start:g.stop + 1]))
                doc, key, inner, is_open, a, z = _ranges_of(
                    line, np.frombuffer(b"".join(lead[g]), np.uint8), n[g].astype(np.int64), lo[sure] + base, hi[sure] + base,
                    example[sure].astype(bool), length)
                yield _chunks([(key, inner.astype(np.int32), is_open, sid[g][doc], a.astype(np.int32), z.astype(np.int32),
                                np.where(is_open, w[g][doc], 2).astype(np.int8))], ["key", "inner", "open", "sid", "lo", "hi", "w"])
    return found.select("sid", "w", "n", "steps", "lead", "m", "s").mapInArrow(
        run, "key bigint, inner int, open boolean, sid bigint, lo int, hi int, w byte")


def _places(rows: DataFrame, *place: str) -> DataFrame:
    return rows.withColumn("place", F.xxhash64(*place))


def _shared(rows: DataFrame, *name: str) -> DataFrame:
    """Names (with an ``r`` before) that an open row has and that occur at two places or in copies; one place may have many rows."""
    return (rows.groupBy(*name).agg(F.max("open").alias("o"), F.min("place").alias("a"), F.max("place").alias("z"),
                                    F.max("w").alias("c"))
            .filter("o and (a != z or c > 1)").select(*[F.col(c).alias(f"r{c}") for c in name]))


def _by_text(ranges: DataFrame) -> DataFrame:
    """(nsid, r): the ranges of every text."""
    return ranges.groupBy(F.col("sid").alias("nsid")).agg(F.collect_list(F.struct("lo", "hi", "inner", "open")).alias("r"))


def sure_classes(classes: DataFrame) -> DataFrame:
    """(ssid, s): the repeated classes (lo, hi, example) of every text; of each name one place is the example."""
    name = ("x", "y", "z")
    placed = _places(classes, "sid", "lo")
    names = (placed.groupBy(*name).agg(F.sum("w").alias("c"), F.min("place").alias("least")).filter("c > 1")
             .select(*[F.col(c).alias(f"r{c}") for c in name], "least"))
    # copies of one text go as a whole; their classes count, but need no answer
    return repeated(placed, names, *name).groupBy(F.col("sid").alias("ssid")).agg(
        F.collect_list(F.struct("lo", "hi", (F.col("place") == F.col("least")).alias("example"))).alias("s"))


def to_name(classes: DataFrame) -> DataFrame:
    """(nsid, r): the ranges (lo, hi, inner, open) of starts to be looked up.

    Open ones whose inner bytes occur at a second place, and the examples of
    repeated classes with these inner bytes, as an open start may equal a start held there.
    """
    # written, so that the join is one of two plain shuffles, whose hot keys are split
    keys = cut(_shared(_places(classes, "sid", "inner"), "key"), "suffix-keys")
    return _by_text(repeated(classes, keys, "key").select("sid", "lo", "hi", "inner", "open"))


def _ranges(b: pa.RecordBatch) -> Iterator[tuple]:
    """(text, sid, w, base, n, lo, hi, inner, open) of the ranges of several texts, which lie in ``text`` from ``base`` on."""
    sid, w = (b.column(c).to_numpy(zero_copy_only=False) for c in (0, 1))
    raw = b.column(2).to_pylist()
    n = _counts(raw, 1)
    off, (lo, hi, inner, is_open) = _per_doc(b.column(3))
    for g in _groups(n, BYTES):
        r, doc = slice(off[g.start], off[g.stop]), np.repeat(np.arange(g.start, g.stop), np.diff(off[g.start:g.stop + 1]))
        base = (np.cumsum(n[g]) - n[g])[doc - g.start]
        yield (Text(b"".join(raw[g])), sid[doc], w[doc], base, n[doc],
               lo[r].astype(np.int64), hi[r].astype(np.int64), inner[r].astype(np.int64), is_open[r])


def _each(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """first, first + 1 ... of every run, ``size`` numbers each."""
    return np.arange(size.sum()) + np.repeat(first - np.cumsum(size) + size, size)


def block_rows(texts: DataFrame, length: int) -> DataFrame:
    """(x, y, u, v, whole, sid, at, lo, hi, inner, open, w): the ranges ``r`` of (sid, w, t, r) cut into blocks.

    Blocks lie at multiples of ``BLOCK`` before the range's inner phrases. A
    block is named by the bytes, from ``at`` on, that all strings of a whole block share (x, y),
    and, where the text holds it wholly, by the bytes that they cover (u, v).
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["x", "y", "u", "v", "whole", "sid", "at", "lo", "hi", "inner", "open", "w"]
        for b in batches:
            out = []
            for text, *ranges in _ranges(b):
                lo, hi, inner = ranges[4:7]
                first = (inner - hi) // BLOCK
                size = (inner - lo) // BLOCK - first + 1
                sid, w, base, n, lo, hi, inner, is_open = (np.repeat(c, size) for c in ranges)
                at = inner - BLOCK * _each(first, size)
                here = base + at
                x, y = text.names(here, here + (length - BLOCK + 1))
                whole = (at >= BLOCK - 1) & (at + length <= n)
                u, v = text.names(np.where(whole, here - BLOCK + 1, here), np.where(whole, here + length, here))
                out.append((x, y, u, v, whole, sid, at.astype(np.int32),
                            np.maximum(lo, at - BLOCK + 1).astype(np.int32), np.minimum(hi, at).astype(np.int32),
                            inner.astype(np.int32), is_open, w))
            if out:
                yield _chunks(out, names)
    return texts.mapInArrow(
        run, "x bigint, y bigint, u bigint, v bigint, whole boolean, sid bigint, at int, lo int, hi int, inner int, "
             "open boolean, w byte")


def settled(blocks: DataFrame) -> DataFrame:
    """The blocks whose shared bytes an open block has twice, with ``done``: all its strings are repeated."""
    placed = _places(blocks, "sid", "at")
    kept = repeated(placed, _shared(placed, "x", "y"), "x", "y")
    whole = (placed.filter("whole").groupBy("u", "v").agg(F.min("place").alias("a"), F.max("place").alias("z"), F.max("w").alias("c"))
             .filter("a != z or c > 1").select(F.col("u").alias("ru"), F.col("v").alias("rv")))
    on = F.col("whole") & (F.col("u") == F.col("ru")) & (F.col("v") == F.col("rv"))
    return cut(kept.join(whole, on, "left").withColumn("done", F.col("ru").isNotNull()).drop("ru", "rv", "place"), "suffix-settled")


def single(marked: DataFrame) -> DataFrame:
    """(nsid, r): the ranges to be named start by start.

    Blocks not done whose shared bytes an open one of them has, and one example of every done block with these bytes.
    The example is a whole block, whatever its range; it may reach into other ranges, where its starts are repeated as well.
    """
    keys = marked.filter("open and not done").select(F.col("x").alias("rx"), F.col("y").alias("ry")).distinct()
    live = repeated(marked, keys, "x", "y")
    some = live.filter("not done").select("sid", "lo", "hi", "inner", "open")
    held = live.filter("done").dropDuplicates(["u", "v"]).select(
        "sid", (F.col("at") - (BLOCK - 1)).alias("lo"), F.col("at").alias("hi"), "inner", F.lit(False).alias("open"))
    return _by_text(some.unionByName(held))


def start_rows(texts: DataFrame, length: int) -> DataFrame:
    """(x, y, sid, p, open, w): the names of the starts in the ranges ``r`` of (sid, w, t, r)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["x", "y", "sid", "p", "open", "w"]
        for b in batches:
            out, held = [], 0
            for text, *ranges in _ranges(b):
                lo, hi = ranges[4:6]
                size = hi - lo + 1
                sid, w, base, is_open = (np.repeat(ranges[c], size) for c in (0, 1, 2, 7))
                p = _each(lo, size)
                x, y = text.names(base + p, base + p + length)
                out.append((x, y, sid, p.astype(np.int32), is_open, w))
                held += len(p)
                if held > 1 << 17:
                    yield _chunks(out, names)
                    out, held = [], 0
            if out:
                yield _chunks(out, names)
    return texts.mapInArrow(run, "x bigint, y bigint, sid bigint, p int, open boolean, w byte")


def spans_of(lo: np.ndarray, hi: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal byte runs [start, end) covered by strings that start in [lo, hi]."""
    order = np.argsort(lo)
    start, end = lo[order], np.maximum.accumulate(hi[order] + length)
    first = np.ones(len(start), bool)
    first[1:] = start[1:] > end[:-1]
    return start[first], end[np.append(np.flatnonzero(first)[1:], len(end)) - 1] if len(end) else end


def repeated_spans(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(k, t, s, p) of every different text with repeated phrases: its repeated starts, as ranges."""
    if length < 2 * WINDOW + GRAM:
        raise ValueError(f"length must be at least {2 * WINDOW + GRAM}")
    sigs = signatures(docs, length)
    marks = levels(sigs, length)
    discard(sigs)
    classes = cut(class_rows(marks, length), "suffix-classes")
    sure = sure_classes(classes)
    none = F.array().cast("array<struct<lo:int,hi:int,example:boolean>>")
    found = cut(marks.join(sure, F.col("sid") == F.col("ssid"), "left").select(
        "sid", F.col("k").alias("fk"), "w", "n", "steps", "lead", "m", F.coalesce("s", none).alias("s")), "suffix-found")
    discard(marks, classes)
    opened = cut(open_classes(found, length), "suffix-open")
    texts = _long_texts(docs, length).groupBy("k").agg(F.first("t").alias("t"))
    cands = cut(texts.join(found.select("sid", "fk", "w", "s"), F.col("k") == F.col("fk")).select("sid", "k", "w", "t", "s"), "suffix-cands")
    discard(found)

    def with_ranges(ranges: DataFrame) -> DataFrame:
        return cands.select("sid", "w", "t").join(ranges, F.col("sid") == F.col("nsid")).select("sid", "w", "t", "r")

    blocks = cut(block_rows(with_ranges(to_name(opened)), length), "suffix-blocks")
    discard(opened)
    marked = settled(blocks)
    discard(blocks)
    rows = cut(start_rows(with_ranges(single(marked)), length), "suffix-starts")
    done = marked.filter("open and done").select("sid", "lo", "hi")
    more = repeated(rows.filter("open").select("x", "y", "sid", "p"), twice(rows, "x", "y"), "x", "y")
    more = done.unionByName(more.select("sid", F.col("p").alias("lo"), F.col("p").alias("hi"))).groupBy(
        F.col("sid").alias("msid")).agg(F.collect_list(F.struct("lo", "hi")).alias("p"))
    return cands.select("sid", "k", "t", "s").join(more, F.col("sid") == F.col("msid"), "left").select(
        "k", "t", "s", F.coalesce("p", F.array().cast("array<struct<lo:int,hi:int>>")).alias("p"))


def apply_spans(spans: DataFrame, length: int) -> DataFrame:
    """(k, n_removed, n_spans, kept) of the texts that lose bytes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw = b.column(1).to_pylist()
            # the texts on one line, a byte between them
            base = np.concatenate([[0], np.cumsum(_counts(raw, 1) + 1)])
            lo, hi = [], []
            for c in (2, 3):
                off, (a, z, *_) = _per_doc(b.column(c))
                at = np.repeat(base[:-1], np.diff(off))
                lo.append(a[off[0]:off[-1]] + at)
                hi.append(z[off[0]:off[-1]] + at)
            start, end = spans_of(np.concatenate(lo), np.concatenate(hi), length)
            of = np.searchsorted(start, base)
            out = []
            for d in np.flatnonzero(np.diff(of)).tolist():
                a, z = start[of[d]:of[d + 1]] - base[d], end[of[d]:of[d + 1]] - base[d]
                kept = b"".join(raw[d][x:y] for x, y in zip([0, *z.tolist()], [*a.tolist(), len(raw[d])]))
                out.append((b.column(0)[d].as_py(), int((z - a).sum()), len(a), kept))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(list(zip(*out)) or [[], [], [], []],
                                                (pa.string(), pa.int64(), pa.int64(), pa.binary()))],
                ["k", "n_removed", "n_spans", "kept"])
    return spans.mapInArrow(run, "k string, n_removed bigint, n_spans bigint, kept binary")


def dedup(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) per row of ``docs`` (doc_id, text)."""
    t = F.coalesce(_bytes(), F.lit("").cast("binary"))
    every = docs.select("doc_id", F.octet_length(t).cast("long").alias("n_bytes"), F.sha2(t, 256).alias("whole"))
    lost = apply_spans(repeated_spans(docs, length), length).select(
        "k", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
    out = every.join(cut(lost, "suffix-lost"), F.col("whole") == F.col("k"), "left")
    zero = F.lit(0).cast("long")
    return out.select("doc_id", "n_bytes", F.coalesce("n_removed", zero).alias("n_removed"),
                      F.coalesce("n_spans", zero).alias("n_spans"),
                      F.coalesce("kept_sha256", "whole").alias("kept_sha256"))


def op5_suffix_dedup(spark, sf_dir):
    """Repeated 400-byte strings removed from all documents."""
    return dedup(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
