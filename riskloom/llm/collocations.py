"""Phrase collocations by Rabin-Karp fingerprints: prefix polynomials, aggregated counts, verified phrases.

A text is lower-cased (A-Z), cut at ``[.,;:!?\\x0A-\\x0D]`` into pieces and
those into words. Numpy prefix sums of ``value[byte] * base^position`` modulo
2^64 give every word's polynomial hash at once, a second prefix sum over the
word hashes the fingerprint of every 1- to 4-gram; the language is mixed in.
Two independent polynomials give fingerprint and check value.

1. *Sketch.* Every task adds up keys, the first bits of the fingerprints, and
   sends them sorted, as distances and counts of about two bytes a key. A key
   has as many bits as the text's size asks for, so it is of few phrases on
   any input; one task counts a range of keys and returns one bit a bucket of
   keys: has one of them ``min_count`` occurrences? The bit map has a bounded
   size (``MAX_BUCKETS``); a fuller one lets more phrases through and never
   loses one.
2. *Counts.* An n-gram is sent on only if its bucket and those of all its
   parts can be frequent. Tasks add up equal fingerprints, the shuffle carries
   them by ranges as packed columns; one task adds up a range exactly, with the
   range of the check values and one occurrence pointer (text and byte offset).
3. *Verification.* Fingerprints with different check values, and those whose
   phrase read at the pointer does not hash to them, are collisions: their
   occurrences are counted again by their text. Phrases are read from the
   texts at the pointers, for frequent fingerprints only.
4. *Scores* are joins of the frequent phrases with their parts, in decimals.

Defined cases: a null or empty text has no words; a null language is ``und``;
copies and repeated rows count each; ties have the contract's order; a
single word or piece of any length is handled in blocks of ``BLOCK`` bytes or
one word, whichever is longer; an empty table gives an empty result; other
columns are never read, their names do not matter.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskloom.llm.common import LOWER_TABLE, cleaned, cut, discard, read_table
from riskloom.session import broadcast_if_small

LENGTHS = 4
MIN_COUNT = 30
TOP = 2000
COVERED_PERCENT = 80
BLOCK = 1 << 19
MIN_BUCKETS, MAX_BUCKETS = 1 << 16, 1 << 28
#: a key and its count are one number; counts stop at ``MOST``
COUNT_BITS = 24
MOST = (1 << COUNT_BITS) - 1
#: keys a task holds before it adds up equal ones; text of a range of keys; rows of a range of fingerprints
KEYS, RANGE_BYTES, RANGE_ROWS = 1 << 21, 8 << 20, 1 << 20
#: rows after which a task adds up equal fingerprints, and most rows of what it adds up before that leaves it
COMPACT_ROWS, TABLE_ROWS = 1 << 18, 1 << 20
#: text of one task: what a task adds up leaves it as one row a phrase, so small input splits are read together
TASK_BYTES = 64 << 20
BATCH_BYTES = 8 << 20
WORD_BYTES = re.compile(rb"[^\x20\x09.,;:!?\x0A-\x0D]+")
_BREAK = re.compile(rb"[\x20\x09.,;:!?\x0A-\x0D]")
#: 0 word byte, 1 space between words, 2 end of a piece
CLASS = np.zeros(256, np.uint8)
CLASS[[0x20, 0x09]] = 1
CLASS[[*b".,;:!?", 0x0A, 0x0B, 0x0C, 0x0D]] = 2

U = np.uint64


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits (a bijection)."""
    h = (h ^ (h >> U(30))) * U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U(27))) * U(0x94D049BB133111EB)
    return h ^ (h >> U(31))


class Polynomial:
    """Hashes of all stretches of a sequence from prefix sums; powers are kept and grow on demand."""

    def __init__(self, seed: int):
        rng = np.random.default_rng(seed)
        self.base = int(rng.integers(1, 1 << 60)) * 8 + 5
        self.inverse = pow(self.base, -1, 1 << 64)
        self.values = rng.integers(0, (1 << 64) - 1, 256, np.uint64)
        self.pow = self.back = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        if len(self.pow) < n + 1:
            n = max(n + 1, len(self.pow) * 9 // 8)
            ones = np.ones(1, np.uint64)
            self.pow = np.concatenate([ones, np.cumprod(np.full(n, self.base, np.uint64))])
            self.back = np.concatenate([ones, np.cumprod(np.full(n, self.inverse, np.uint64))])

    def prefixes(self, seq: np.ndarray) -> np.ndarray:
        self._grow(len(seq))
        out = np.zeros(len(seq) + 1, np.uint64)
        np.cumsum(seq * self.pow[:len(seq)], out=out[1:])
        return out

    def stretch(self, prefixes: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return (prefixes[stop] - prefixes[start]) * self.back[start]


class Hashes:
    """Fingerprint (0) and check value (1) of n-grams."""

    def __init__(self, bits: int = 64):
        self.mask = U((1 << bits) - 1)      # fewer bits make collisions for tests
        self.of_bytes = [Polynomial(11), Polynomial(12)]
        self.of_words = [Polynomial(13), Polynomial(14)]

    def words(self, k: int, data: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        p = self.of_bytes[k]
        return mix(p.stretch(p.prefixes(p.values[data]), start, stop) + (stop - start).astype(np.uint64))

    def grams(self, k: int, words: np.ndarray, seeds: np.ndarray) -> list[np.ndarray]:
        """For each length n the value of the n-gram that starts at each word that has n words after it."""
        p = self.of_words[k]
        pre, at = p.prefixes(words), np.arange(len(words))
        out = []
        for n in range(1, LENGTHS + 1):
            i = at[:max(0, len(words) - n + 1)]
            h = mix((p.stretch(pre, i, i + n) + U(n * 0x9E3779B97F4A7C15 % (1 << 64))) ^ seeds[i])
            out.append(h & self.mask if k == 0 else h)
        return out


def lang_seed(lang: str) -> int:
    """A number of a language name, the same in every process."""
    import hashlib
    return int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little")


def parts(t: bytes, size: int = BLOCK) -> Iterator[tuple[int, int, int]]:
    """(start, stop, lead) of stretches of a text: cut after a piece, else after a word.

    After a cut inside a piece the next stretch starts ``lead`` words earlier;
    those were counted already and only serve as context.
    """
    start = done = lead = 0
    while done < len(t):
        stop = done + size
        if stop >= len(t):
            yield start, len(t), lead
            return
        kinds = CLASS[np.frombuffer(t, np.uint8, size, done)]
        ends, spaces = np.flatnonzero(kinds == 2), np.flatnonzero(kinds == 1)
        if len(ends):
            done = done + int(ends[-1]) + 1
            yield start, done, lead
            start, lead = done, 0
            continue
        if len(spaces):
            at = done + int(spaces[-1]) + 1
        else:
            m = _BREAK.search(t, stop)
            at = m.end() if m else len(t)
        yield start, at, lead
        own = CLASS[np.frombuffer(t, np.uint8, at - start, start)] == 0
        first = np.flatnonzero(own & ~np.r_[False, own[:-1]])
        lead = min(LENGTHS - 1, len(first))
        start, done = (start + int(first[-lead]) if lead else at), at


class Block:
    """Words of several stretches of texts, with everything the n-grams need."""

    def __init__(self, stretches: list[tuple[bytes, int, int, int, int]]):
        """``stretches``: (bytes, text number, offset in the text, lead, language seed)."""
        data = b"\n".join(s[0] for s in stretches).translate(LOWER_TABLE)
        self.raw = data
        self.data = np.frombuffer(data, np.uint8)
        kinds = CLASS[self.data]
        own = kinds == 0
        edge = np.diff(np.r_[False, own, False].astype(np.int8))
        self.start, self.stop = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        self.piece = np.cumsum(kinds == 2)[self.start] if len(self.start) else np.zeros(0, np.int64)
        sizes = np.array([len(s[0]) + 1 for s in stretches])
        begin = np.cumsum(sizes) - sizes
        self.stretch = np.searchsorted(begin, self.start, "right") - 1
        self.text = np.array([s[1] for s in stretches])[self.stretch]
        self.offset = self.start - begin[self.stretch] + np.array([s[2] for s in stretches])[self.stretch]
        self.seed = np.array([s[4] for s in stretches], np.uint64)[self.stretch]
        lead = np.array([s[3] for s in stretches])
        first = np.searchsorted(self.stretch, np.arange(len(stretches)))
        self.context = np.arange(len(self.start)) - first[self.stretch] < lead[self.stretch]

    def valid(self, n: int) -> np.ndarray:
        """Which words start an n-gram inside one piece that was not counted in the stretch before."""
        m = max(0, len(self.start) - n + 1)
        return (self.piece[:m] == self.piece[n - 1:]) & ~self.context[n - 1:] if m else np.zeros(0, bool)

    def grams(self, hashes: Hashes, k: int) -> list[np.ndarray]:
        return hashes.grams(k, hashes.words(k, self.data, self.start, self.stop), self.seed)

    def phrase(self, i: int, n: int) -> bytes:
        return b" ".join(self.raw[self.start[j]:self.stop[j]] for j in range(i, i + n))


def blocks(texts: list[bytes | None], seeds: list[int], size: int | None = None) -> Iterator[Block]:
    size = size or BLOCK
    pile, held = [], 0
    for i, t in enumerate(texts):
        for start, stop, lead in parts(t or b"", size):
            pile.append((t[start:stop], i, start, lead, seeds[i]))
            held += stop - start
            if held >= size:
                yield Block(pile)
                pile, held = [], 0
    if pile:
        yield Block(pile)


def _texts(docs: DataFrame, id_col: str, text: str, lang: str) -> DataFrame:
    """(t, lang, text): t names a row by id and text in 32 bits, for the pointers; a phrase is looked for in all rows of a name."""
    return docs.select(F.shiftrightunsigned(F.xxhash64(F.col(f"`{id_col}`"), F.col(f"`{text}`")), 32).alias("t"),
                       F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit("und")).alias("lang"),
                       F.col(f"`{text}`").cast("string").cast("binary").alias("text"))


@contextmanager
def batches_of(spark: SparkSession, size: int) -> Iterator[None]:
    """While it lasts, Arrow batches end at ``size`` bytes, so that a task's memory does not follow the length of texts."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(size))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _per_block(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Block, pa.RecordBatch]]:
    for b in batches:
        langs = b.column("lang").to_pylist()
        seeds = {x: lang_seed(x) for x in set(langs)}
        for block in blocks(b.column("text").to_pylist(), [seeds[x] for x in langs]):
            yield block, b


def _bucket(h: np.ndarray, buckets: int) -> np.ndarray:
    return (h >> U(65 - buckets.bit_length())).astype(np.int64)


def _power(x: float, least: int = 1) -> int:
    """The power of two that is ``x`` or the next above it, ``least`` at least."""
    return max(least, 1 << max(0, math.ceil(math.log2(max(1, x)))))


def _pack(columns: list[np.ndarray]) -> bytes:
    """Columns of numbers (uint64) of one length, byte plane by byte plane; a column of zeros takes one byte.

    Planes below the two highest hold the low ends of hashes and are kept as they are.
    """
    pack = zstandard.ZstdCompressor(level=1, write_content_size=True).compress
    out = [len(columns[0]).to_bytes(4, "little")]
    for x in columns:
        planes = np.ascontiguousarray(x, "<u8").view(np.uint8).reshape(-1, 8)
        width = (int(x.max()).bit_length() + 7) // 8
        out.append(bytes([width]))
        for i in range(width):
            plane = planes[:, i].tobytes()
            if i >= width - 2:
                plane = pack(plane)
                out.append(len(plane).to_bytes(4, "little"))
            out.append(plane)
    return b"".join(out)


def _unpack(data: bytes) -> list[np.ndarray]:
    unpack = zstandard.ZstdDecompressor().decompress
    n, at, out = int.from_bytes(data[:4], "little"), 4, []
    while at < len(data):
        width, at = data[at], at + 1
        planes = np.zeros((n, 8), np.uint8)
        for i in range(width):
            size = n
            if i >= width - 2:
                size, at = int.from_bytes(data[at:at + 4], "little"), at + 4
            plane, at = data[at:at + size], at + size
            planes[:, i] = np.frombuffer(unpack(plane) if i >= width - 2 else plane, np.uint8)
        out.append(planes.view("<u8")[:, 0])
    return out


def _steps(values: np.ndarray, base: int) -> np.ndarray:
    """Ascending numbers as their distances, the first from ``base``."""
    out = values.copy()
    out[1:] -= values[:-1]
    out[0] -= U(base)
    return out


def _added(packed: list[np.ndarray]) -> np.ndarray:
    """Numbers ``key << COUNT_BITS | count`` in ascending order, counts of equal keys added up to ``MOST`` at most."""
    x = np.concatenate(packed) if packed else np.zeros(0, np.uint64)
    packed.clear()
    x.sort()
    key = x >> U(COUNT_BITS)
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(x) else np.zeros(0, np.int64)
    x &= U(MOST)
    return key[first] << U(COUNT_BITS) | np.minimum(np.add.reduceat(x, first), U(MOST)) if len(x) else x


def _by_range(rows: Iterator[tuple[int, bytes]], names: tuple[str, str], size: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Batches of about ``size`` bytes of (range, data)."""
    held, n = [], 0
    for row in rows:
        held.append(row)
        n += len(row[1])
        if n >= size:
            yield _ranges_batch(held, names)
            held, n = [], 0
    if held:
        yield _ranges_batch(held, names)


def _ranges_batch(held: list[tuple[int, bytes]], names: tuple[str, str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r for r, _ in held], pa.int32()), pa.array([d for _, d in held], pa.binary())], list(names))


def can_be_frequent(rows: DataFrame, size: int, buckets: int, min_count: int, bits: int) -> tuple[bytes, DataFrame, int]:
    """(bit map of the buckets that reach ``min_count``, (lang, n) of all word occurrences, most rows a task table has of them).

    Counted are keys, the first bits of the fingerprints, one key or more for
    every byte of text: so few phrases share one, however large the table is.
    """
    ranges = _power(size / RANGE_BYTES)
    key_bits = min(64 - COUNT_BITS, max(buckets.bit_length() - 1, _power(size).bit_length() - 1))
    wide = key_bits - (ranges.bit_length() - 1)         # bits of a key within its range

    def sketch(batches):
        hashes, totals, held, n = Hashes(bits), Counter(), [], 0

        def sent(table):
            at = np.searchsorted(table >> U(COUNT_BITS + wide), np.arange(ranges + 1, dtype=np.uint64))
            for r in np.flatnonzero(np.diff(at)).tolist():
                own = table[at[r]:at[r + 1]]
                yield r, _pack([_steps(own >> U(COUNT_BITS), r << wide), own & U(MOST)])

        def tables():
            nonlocal held, n
            for block, b in _per_block(batches):
                for text, c in zip(*np.unique(block.text[~block.context], return_counts=True)):
                    totals[b.column("lang")[int(text)].as_py()] += int(c)
                for k, h in enumerate(block.grams(hashes, 0), 1):
                    h = h[block.valid(k)]
                    held.append(h >> U(64 - key_bits) << U(COUNT_BITS) | U(1))
                    n += len(h)
                if n >= KEYS:
                    table = _added(held)
                    held, n = [table], len(table)
                    if n >= KEYS // 2:
                        held, n = [], 0
                        yield from sent(table)
                    del table
            if n:
                yield from sent(_added(held))
        for batch in _by_range(tables(), ("range", "data")):
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.nulls(batch.num_rows, pa.string()), pa.nulls(batch.num_rows, pa.int64())],
                                             ["range", "data", "lang", "words"])
        if totals:
            none = pa.nulls(len(totals), pa.binary())
            yield pa.RecordBatch.from_pydict({"range": pa.array([0] * len(totals), pa.int32()), "data": none,
                                              "lang": pa.array(list(totals)), "words": pa.array(list(totals.values()), pa.int64())})

    def add(batches):
        held, n, own, sent, totals = [], 0, None, 0, Counter()
        for b in batches:
            for r, data, lang, words in zip(*(b.column(c).to_pylist() for c in ("range", "data", "lang", "words"))):
                if data is None:
                    totals[lang] += words
                    continue
                key, count = _unpack(data)
                key[0] += U(r << wide)
                held.append(np.cumsum(key) << U(COUNT_BITS) | count)
                own, sent, n = r, sent + 1, n + len(key)
                if n >= 4 * KEYS:
                    held = [_added(held)]
                    n = len(held[0])
        if own is not None:
            table = _added(held)
            table = table[(table & U(MOST)) >= min(min_count, MOST)]
            bit = np.zeros(buckets // ranges, bool)
            bit[((table >> U(COUNT_BITS + key_bits - buckets.bit_length() + 1)) & U(len(bit) - 1)).astype(np.int64)] = True
            yield pa.RecordBatch.from_pydict({
                "range": pa.array([own], pa.int32()), "bits": pa.array([np.packbits(bit, bitorder="little").tobytes()], pa.binary()),
                "rows": pa.array([int(np.minimum(table & U(MOST), U(sent)).sum())], pa.int64()),
                "lang": pa.nulls(1, pa.string()), "words": pa.nulls(1, pa.int64())})
        if totals:
            n = len(totals)
            yield pa.RecordBatch.from_pydict({"range": pa.nulls(n, pa.int32()), "bits": pa.nulls(n, pa.binary()), "rows": pa.nulls(n, pa.int64()),
                                              "lang": pa.array(list(totals)), "words": pa.array(list(totals.values()), pa.int64())})
    tables = rows.mapInArrow(sketch, "range int, data binary, lang string, words bigint").repartitionById(ranges, "range")
    part = cut(tables.mapInArrow(add, "range int, bits binary, rows bigint, lang string, words bigint"), "sketch")
    # one bit a bucket: MAX_BUCKETS / 8 bytes at most, 32 MB
    bitmap, most, each = np.zeros(buckets // 8, np.uint8), 0, buckets // ranges // 8
    for r in part.filter("range IS NOT NULL").select("range", "bits", "rows").collect():
        bitmap[r["range"] * each:(r["range"] + 1) * each] = np.frombuffer(r["bits"], np.uint8)
        most += r["rows"]
    totals = cut(part.filter("lang IS NOT NULL").groupBy("lang").agg(F.sum("words").alias("n")), "words")
    discard(part)
    return bitmap.tobytes(), totals, most


def _compact(rows: list[list[np.ndarray]]) -> list[np.ndarray]:
    """Columns h, low, high, n, t, at with equal fingerprints added up, at the least t; ``rows`` are emptied column by column."""
    def taken(i: int) -> np.ndarray:
        out = np.concatenate([r[i] for r in rows])
        for r in rows:
            r[i] = None
        return out
    h = taken(0)
    order = np.argsort(h, kind="stable")
    h = h[order]
    first = np.flatnonzero(np.r_[True, h[1:] != h[:-1]])
    out, size = [h[first]], len(h)
    del h
    out += [f.reduceat(taken(i)[order], first) for i, f in ((1, np.minimum), (2, np.maximum), (3, np.add))]
    t = taken(4)[order]
    least = np.minimum.reduceat(t, first)
    one = np.flatnonzero(t == np.repeat(least, np.diff(np.r_[first, size])))
    one = order[one[np.searchsorted(one, first)]]
    return out + [least, taken(5)[one]]


def _tables(rows: Iterator[list[np.ndarray]]) -> Iterator[list[np.ndarray]]:
    """Columns as in ``_compact``: equal fingerprints are one row until ``TABLE_ROWS`` different ones are held."""
    held, size = [], 0
    for r in rows:
        held.append(r)
        size += len(r[0])
        if size > COMPACT_ROWS:
            held, size = [_compact(held)], 0
            if len(held[0][0]) >= TABLE_ROWS:
                yield held.pop()
    if held:
        yield _compact(held)


def counted(rows: DataFrame, bitmap, buckets: int, most: int, min_count: int, bits: int) -> DataFrame:
    """(h, low, high, f, t, at) of the fingerprints with ``min_count`` occurrences or more.

    ``most``: about how many rows the tables of all tasks have. They are
    shuffled as packed columns of a range of fingerprints, half the size of
    Spark's rows: the rows of frequent phrases are most of what is on disk.
    """
    ranges = _power(most / RANGE_ROWS)
    wide = 65 - ranges.bit_length()         # bits of a fingerprint within its range

    def count(batches):
        hashes = Hashes(bits)
        seen = np.frombuffer(bitmap.value, np.uint8)

        def per_length():
            for block, b in _per_block(batches):
                t = b.column("t").to_numpy(zero_copy_only=False)
                one, two = block.grams(hashes, 0), block.grams(hashes, 1)
                may = None
                for n, h in enumerate(one, 1):
                    at = _bucket(h, buckets)
                    own = ((seen[at >> 3] >> (at & 7).astype(np.uint8)) & 1).astype(bool)
                    may = own if may is None else own & may[:len(own)] & may[1:]
                    at = np.flatnonzero(may & block.valid(n))
                    if len(at):
                        c = two[n - 1][at].view(np.int64)
                        yield _compact([[h[at].view(np.int64), c, c, np.ones(len(at), np.int64),
                                         t[block.text[at]], block.offset[at] * 8 + n]])

        def sent():
            for h, low, high, n, t, at in _tables(per_length()):
                h, low, high, n, t, at = (c.view(np.uint64) for c in (h, low, high, n, t, at))
                # signed order: the upper half of the ranges comes first
                own = (h >> U(wide)).astype(np.int64) if ranges > 1 else np.zeros(len(h), np.int64)
                edge = np.flatnonzero(np.r_[True, own[1:] != own[:-1], True])
                for i, j in zip(edge[:-1].tolist(), edge[1:].tolist()):
                    k = slice(i, j)
                    yield int(own[i]), _pack([_steps(h[k], int(own[i]) << wide), low[k], high[k] - low[k], n[k], t[k], at[k]])
                del h, low, high, n, t, at, own      # not held beside the next table
        yield from _by_range(sent(), ("range", "data"))

    def add(batches):
        held = []
        for b in batches:
            for r, data in zip(b.column("range").to_pylist(), b.column("data").to_pylist()):
                h, low, high, n, t, at = _unpack(data)
                h[0] += U(r << wide)
                held.append([c.view(np.int64) for c in (np.cumsum(h), low, low + high, n, t, at)])
        if held:
            columns = _compact(held)
            own = np.flatnonzero(columns[3] >= min_count)
            for i in range(0, len(own), 100_000):
                yield pa.RecordBatch.from_arrays([pa.array(c[own[i:i + 100_000]]) for c in columns], ["h", "low", "high", "f", "t", "at"])
    got = rows.mapInArrow(count, "range int, data binary").repartitionById(ranges, "range")
    return got.mapInArrow(add, "h bigint, low bigint, high bigint, f bigint, t bigint, at bigint")


def phrases_at(rows: DataFrame, frequent: DataFrame, bits: int) -> DataFrame:
    """(h, lang, n, phrase) read at the pointers; only phrases that hash to their fingerprint and check value."""
    asked = frequent.groupBy("t").agg(F.collect_list(F.struct("h", "low", "at")).alias("asked"))
    found = rows.join(broadcast_if_small(cut(asked, "pointers")), "t")
    found = found.select("lang", "text", F.col("asked.h").alias("h"), F.col("asked.low").alias("low"), F.col("asked.at").alias("at"), "t")

    def read(batches):
        hashes, told = Hashes(bits), set()
        for b in batches:
            texts, langs, names = b.column("text").to_pylist(), b.column("lang").to_pylist(), b.column("t").to_pylist()
            for i in range(b.num_rows):
                row = names[i], langs[i], hash(texts[i])
                if texts[i] is None or row in told:       # a repeated row: the same phrases again
                    continue
                told.add(row)
                low_text = texts[i].translate(LOWER_TABLE)
                h, low, at = (np.array(b.column(c)[i].as_py(), np.int64) for c in ("h", "low", "at"))
                for j in range(0, len(h), 50_000):
                    got = []
                    for p in at[j:j + 50_000].tolist():
                        found, pos = [], p >> 3
                        for _ in range(p & 7):
                            m = WORD_BYTES.search(low_text, pos)
                            if m is None:
                                break
                            found.append(m.group())
                            pos = m.end()
                        got.append(b" ".join(found))
                    seed = lang_seed(langs[i])
                    block = Block([(g, k, 0, 0, seed) for k, g in enumerate(got)])
                    one, two = block.grams(hashes, 0), block.grams(hashes, 1)
                    first = np.searchsorted(block.text, np.arange(len(got)))
                    n = at[j:j + 50_000] & 7
                    ok = np.zeros(len(got), bool)
                    for k in range(1, LENGTHS + 1):
                        w = np.flatnonzero((n == k) & (first < len(one[k - 1])))
                        ok[w] = ((one[k - 1][first[w]].view(np.int64) == h[j:j + 50_000][w])
                                 & (two[k - 1][first[w]].view(np.int64) == low[j:j + 50_000][w]))
                    own = np.flatnonzero(ok)
                    yield pa.RecordBatch.from_pydict({
                        "h": pa.array(h[j:j + 50_000][own]), "lang": pa.array([langs[i]] * len(own), pa.string()),
                        "n": pa.array(n[own].astype(np.int32)), "phrase": pa.array([got[k].decode() for k in own], pa.string())})
    return found.mapInArrow(read, "h bigint, lang string, n int, phrase string").dropDuplicates(["h"])


def counted_by_text(rows: DataFrame, doubtful: DataFrame, min_count: int, bits: int) -> DataFrame:
    """(lang, n, phrase, f) of all phrases whose fingerprint is in ``doubtful``, counted by their text.

    A bit map of the fingerprints (2^20 bits) picks the occurrences whose text is looked at.
    """
    size = 1 << 20
    bit = F.pmod(F.col("h"), F.lit(size))
    hit = np.zeros(size, bool)
    for r in doubtful.select(bit.alias("b")).distinct().collect():
        hit[r["b"]] = True
    maps = rows.sparkSession.sparkContext.broadcast(hit)

    def count(batches):
        hashes = Hashes(bits)
        for block, b in _per_block(batches):
            langs, own = b.column("lang"), Counter()
            for n, h in enumerate(block.grams(hashes, 0), 1):
                at = np.flatnonzero(block.valid(n) & maps.value[(h % U(size)).astype(np.int64)])
                own.update((int(h[i].view(np.int64)), langs[int(block.text[i])].as_py(), n, block.phrase(i, n)) for i in at)
            keys = list(own)
            yield pa.RecordBatch.from_pydict({
                "h": pa.array([k[0] for k in keys], pa.int64()), "lang": pa.array([k[1] for k in keys], pa.string()),
                "n": pa.array([k[2] for k in keys], pa.int32()), "phrase": pa.array([k[3].decode() for k in keys], pa.string()),
                "f": pa.array(list(own.values()), pa.int64())})
    got = rows.mapInArrow(count, "h bigint, lang string, n int, phrase string, f bigint")
    sums = got.groupBy("h", "lang", "n", "phrase").agg(F.sum("f").alias("f")).filter(F.col("f") >= min_count)
    return sums.join(doubtful.select("h").distinct(), "h", "left_semi").select("lang", "n", "phrase", "f")


def frequent_phrases(docs: DataFrame, id_col: str = "doc_id", text: str = "text", lang: str = "lang",
                     min_count: int = MIN_COUNT, bits: int = 64) -> tuple[DataFrame, DataFrame]:
    """((lang, n, phrase, f) of all phrases of 1 to 4 words, (lang, n) of all word occurrences)."""
    spark = docs.sparkSession
    rows = _texts(docs, id_col, text, lang)
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # about a bucket for every three words
    buckets = min(MAX_BUCKETS, _power(size / 16, MIN_BUCKETS))
    rows = rows.coalesce(max(spark.sparkContext.defaultParallelism, math.ceil(size / TASK_BYTES)))
    with batches_of(spark, BATCH_BYTES):
        bitmap, totals, most = can_be_frequent(rows, size, buckets, min_count, bits)
        cleaned(spark)
        bitmap = spark.sparkContext.broadcast(bitmap)
        found = cut(counted(rows, bitmap, buckets, most, min_count, bits), "fingerprints")
        read = cut(phrases_at(rows, found.filter("low = high"), bits), "phrases")
        phrases = found.join(read, "h").select("lang", "n", "phrase", "f")
        doubtful = found.join(read, "h", "left_anti")
        if not doubtful.isEmpty():
            phrases = phrases.unionByName(counted_by_text(rows, doubtful, min_count, bits))
        out = cut(phrases, "frequent-phrases")
    bitmap.destroy()
    discard(found, read)
    return out, totals


def collocations(phrases: DataFrame, totals: DataFrame, top: int = TOP, covered: int = COVERED_PERCENT) -> DataFrame:
    """The best ``top`` phrases of each language: lang, rank, phrase, a, l, r, n, score."""
    words = F.split("phrase", " ")
    cuts = phrases.filter("n > 1").select("lang", "phrase", F.col("f").alias("a"), words.alias("w"), F.size(words).alias("size")) \
        .withColumn("k", F.explode(F.expr("sequence(1, size - 1)")))
    cuts = cuts.select("lang", "phrase", "a", "k", F.expr("array_join(slice(w, 1, k), ' ')").alias("left"),
                       F.expr("array_join(slice(w, k + 1, size - k), ' ')").alias("right"))
    part = lambda side, f: phrases.select("lang", F.col("phrase").alias(side), F.col("f").alias(f))
    scored = cuts.join(part("left", "l"), ["lang", "left"]).join(part("right", "r"), ["lang", "right"])
    exact = "cast(2000000 as decimal(18,0)) * cast(a as decimal(19,0)) div cast(cast(l as decimal(19,0)) + cast(r as decimal(19,0)) as decimal(20,0))"
    scored = scored.withColumn("score", F.expr(exact).cast("bigint"))
    best = scored.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    # the most frequent longer phrase around each phrase
    longer = phrases.filter("n > 2").select("lang", "f", words.alias("w"), F.size(words).alias("size"))
    inner = longer.withColumn("len", F.explode(F.expr("sequence(2, size - 1)"))) \
        .withColumn("from", F.explode(F.expr("sequence(1, size - len + 1)")))
    around = inner.groupBy("lang", F.expr("array_join(slice(w, from, len), ' ')").alias("phrase")).agg(F.max("f").alias("around"))
    kept = best.join(around, ["lang", "phrase"], "left").filter(
        F.col("around").isNull() | (100 * F.col("around").cast("decimal(19,0)") < covered * F.col("a").cast("decimal(19,0)")))
    by = Window.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("a"), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(by).cast("long")).filter(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")


def op13_collocations(spark, sf_dir):
    """Collocations of all documents, by language."""
    return collocations(*frequent_phrases(read_table(spark, sf_dir, "documents")))
