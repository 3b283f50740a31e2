"""Benchmark decontamination: a hash set of normalised test n-grams, scanned over training texts.

Benchmark items are cut into windows of ``n`` consecutive words (an item
with fewer words is one shorter window). The windows are numbered words
plus a 64-bit rolling hash, broadcast to the tasks; every document is one
pass: words to numbers, runs of benchmark words, hash look-up, then an exact
comparison of the numbers. A word inside any occurrence of a window is hit.

The broadcast is bounded: distinct items are cut into slices of at most
``slice_bytes`` (measured), by a hash of the item, and each slice is one more
pass that adds its hits to those of the passes before. No row is shuffled.
A benchmark that takes more than ``MAX_SLICES`` of them, or has a slice that
is too large, is joined: a bit set of fixed size over the window hashes is
broadcast, the document windows that it lets through are shuffled once a
different text and joined with the benchmark's windows by their words.

Defined cases: a null text (document or item) has no words; a text without
words hits nothing; repeated items count once per distinct ``item_id``;
windows of an item with a null id count as hits but name no item; an empty
benchmark hits nothing; repeated documents are scanned each for itself.
"""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import ALNUM_TABLE, cut, map_text

WINDOW = 10
SLICE_BYTES = 8 << 20
#: a plan has one Arrow map a slice, so their number is bounded too
MAX_SLICES = 4
#: bits of the window filter of larger benchmarks (16 MB); a full filter lets more rows through, results are the same
FILTER_BITS = 1 << 27
#: bits of one ``bitmap_construct_agg``
_BUCKET = 1 << 15
_WORD = re.compile(rb"[0-9a-zA-Z\x80-\xff]+")
_BASE = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(ALNUM_TABLE).split() if text else []


def _hashes(ids: np.ndarray, n: int) -> np.ndarray:
    """Polynomial hash (mod 2^64) of every run of ``n`` word numbers."""
    out = np.zeros(len(ids) - n + 1, np.uint64)
    for j in range(n):
        out = out * _BASE + ids[j:j + len(out)]
    return out


class WindowIndex:
    """Windows of one benchmark slice: word numbers, and by length the hash -> (words, items) table."""

    def __init__(self, items: list[tuple[str | None, bytes | None]], n: int) -> None:
        self.vocab: dict[bytes, int] = {}
        found: dict[tuple[int, ...], set] = {}
        for item, text in items:
            ids = [self.vocab.setdefault(w, len(self.vocab) + 1) for w in words_of(text)]
            if not ids:
                continue
            size = min(n, len(ids))
            for i in range(len(ids) - size + 1):
                found.setdefault(tuple(ids[i:i + size]), set()).add(item)
        self.by_size: dict[int, tuple[np.ndarray, dict]] = {}
        for size in sorted({len(k) for k in found}):
            keys = [k for k in found if len(k) == size]
            table: dict[int, list] = {}
            for k, h in zip(keys, _hashes(np.array(keys, np.uint64).reshape(-1), size)[::size].tolist()):
                table.setdefault(h, []).append((k, tuple(x for x in found[k] if x is not None)))
            self.by_size[size] = (np.array(sorted(table), np.uint64), table)

    def hits(self, words: list[bytes]) -> tuple[np.ndarray | None, set]:
        """(hit flag per word or None, item ids) of one document."""
        n = len(words)
        if not n or not self.by_size:
            return None, set()
        ids = np.fromiter(map(self.vocab.get, words, repeat(0)), np.uint64, n)
        unknown = np.zeros(n + 1, np.int64)
        np.cumsum(ids == 0, out=unknown[1:])
        flags, items = None, set()
        for size, (keys, table) in self.by_size.items():
            if n < size:
                continue
            start = np.flatnonzero(unknown[size:] == unknown[:n + 1 - size])
            if not len(start):
                continue
            h = np.zeros(len(start), np.uint64)
            for j in range(size):
                h = h * _BASE + ids[start + j]
            at = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
            for i, key in zip(start[keys[at] == h].tolist(), h[keys[at] == h].tolist()):
                got = tuple(ids[i:i + size].tolist())
                for k, names in table[key]:
                    if k == got:  # the hash only proposes
                        flags = np.zeros(n, bool) if flags is None else flags
                        flags[i:i + size] = True
                        items.update(names)
        return flags, items


def _slices(items: DataFrame, at: Column, slice_bytes: int) -> int:
    """The number of slices; 0 where the bound can't be kept. ``at`` is the hash that deals the items."""
    size = F.sum(sum(F.coalesce(F.octet_length(c), F.lit(0)) for c in ("text", "item_id")))
    total = items.agg(size).first()[0] or 0
    if total <= slice_bytes:
        return 1
    # hashed slices are uneven: aim at half the bound
    slices = math.ceil(2 * total / slice_bytes)
    if slices > MAX_SLICES:
        return 0
    largest = items.groupBy(F.pmod(at, F.lit(slices)).alias("s")).agg(size.alias("n")).agg(F.max("n")).first()[0]
    return slices if largest <= slice_bytes else 0


def scan(docs: DataFrame, benchmark: DataFrame, keep: list[str], n: int = WINDOW,
         slice_bytes: int = SLICE_BYTES, text: str = "text") -> DataFrame:
    """``keep`` columns plus ``n_words``, ``hit_words`` (sorted word positions), ``items`` (sorted ids as text)."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"),
                             F.col("text").cast("string").alias("text")).distinct()
    at = F.xxhash64("item_id", "text")
    slices = _slices(items, at, slice_bytes)
    if not slices:
        return scan_by_join(docs, items, keep, n, text)
    return scan_by_slices(docs, items, keep, n, [items.filter(F.pmod(at, F.lit(slices)) == s) for s in range(slices)], text)


def scan_by_slices(docs: DataFrame, items: DataFrame, keep: list[str], n: int, parts: list[DataFrame], text: str) -> DataFrame:
    """``scan`` with the windows of each part of the items broadcast."""
    sc = docs.sparkSession.sparkContext
    out, names = None, list(keep)
    for s, part in enumerate(parts if len(parts) > 1 else [items]):
        rows = [(r[0], None if r[1] is None else r[1].encode()) for r in part.collect()]
        index = sc.broadcast(WindowIndex(rows, n))

        def make(index=index):
            idx = index.value

            def f(texts, hit=None, found=None):
                counts, flags_out, items_out = [], [], []
                for i, t in enumerate(texts):
                    words = words_of(t)
                    flags, got = idx.hits(words)
                    pos = [] if flags is None else np.flatnonzero(flags).tolist()
                    if hit is not None:
                        pos, got = sorted({*pos, *hit[i]}), {*got, *found[i]}
                    counts.append(len(words))
                    flags_out.append(pos)
                    items_out.append(sorted(got))
                return counts, flags_out, items_out
            return f

        fields = "n_words bigint, hit_words array<int>, items array<string>"
        if out is None:
            # the text stays on board only while another slice has to read it
            held = names if len(parts) == 1 else [*names, text] if text not in names else names
            out = map_text(docs, held, make, fields, text=text)
        else:
            last = s == len(parts) - 1
            held = names if last or text in names else [*names, text]
            out = map_text(out, held, make, fields, text=text, extra=["hit_words", "items"])
    return out


def _codes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(zlib.crc32, words), np.uint64, len(words))


def _bits(codes: np.ndarray, size: int, filter_bits: int) -> np.ndarray:
    """The bit of every window of ``size`` words; ``filter_bits`` is a power of two."""
    h = _hashes(codes + np.uint64(1), size)
    h = (h ^ (h >> np.uint64(32))) * _BASE
    return (h >> np.uint64(65 - filter_bits.bit_length())).astype(np.int64)


def _windows(items: DataFrame, n: int, filter_bits: int) -> DataFrame:
    """(item_id, size, bit, win) of the windows of all items; ``win`` is the words with a space between."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for item, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                words = words_of(t)
                size = min(n, len(words))
                if size:
                    wins = [b" ".join(words[i:i + size]) for i in range(len(words) - size + 1)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([item] * len(wins), pa.string()), pa.array([size] * len(wins), pa.int32()),
                         pa.array(_bits(_codes(words), size, filter_bits)), pa.array(wins, pa.binary())],
                        ["item_id", "size", "bit", "win"])
    return items.select("item_id", F.col("text").cast("binary")).mapInArrow(
        run, "item_id string, size int, bit bigint, win binary")


def _proposed(docs: DataFrame, sizes: list[int], bitmap: bytes, filter_bits: int, text: str) -> DataFrame:
    """(text_key, pos, size, win) of the document windows that the filter lets through, once a different text."""
    sent = docs.sparkSession.sparkContext.broadcast(bitmap)
    names = ["text_key", "pos", "size", "win"]
    types = (pa.string(), pa.int32(), pa.int32(), pa.binary())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, out = np.frombuffer(sent.value, np.uint8), []

        def batch():
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)

        for b in batches:
            for t in b.column(0).to_pylist():
                words = words_of(t)
                codes, key = _codes(words), hashlib.sha256(t).hexdigest()
                for size in (k for k in sizes if k <= len(words)):
                    bit = _bits(codes, size, filter_bits)
                    for i in np.flatnonzero(bits[bit >> 3] >> (bit & 7).astype(np.uint8) & 1).tolist():
                        out.append((key, i, size, b" ".join(words[i:i + size])))
                        if len(out) >= 1 << 16:
                            yield batch()
                            out.clear()
        if out:
            yield batch()
    texts = docs.select(F.col(f"`{text}`").cast("string").cast("binary").alias("t")).filter("t is not null")
    return texts.mapInArrow(run, "text_key string, pos int, size int, win binary").distinct()


def scan_by_join(docs: DataFrame, items: DataFrame, keep: list[str], n: int = WINDOW, text: str = "text",
                 filter_bits: int = FILTER_BITS) -> DataFrame:
    """``scan`` without a table of the benchmark in any task: windows that pass a bit set are joined by their words."""
    # one row a different window; copies of an item's window collapse before the shuffle
    wins = _windows(items, n, filter_bits)
    table = cut(wins.groupBy("win", "size", "bit").agg(F.collect_set("item_id").alias("ids")), "benchmark-windows")
    sizes = sorted(r[0] for r in table.select("size").distinct().collect())
    # at most filter_bits / 2^15 rows of 4 KB
    bitmap = bytearray(max(filter_bits, _BUCKET) // 8)
    for r in (table.groupBy(F.expr(f"bit div {_BUCKET}").alias("b"))
              .agg(F.bitmap_construct_agg(F.col("bit") % _BUCKET).alias("m")).toLocalIterator()):
        at = r["b"] * _BUCKET // 8
        bitmap[at:at + len(r["m"])] = r["m"]
    found = cut(_proposed(docs, sizes, bytes(bitmap), filter_bits, text), "proposed-windows")
    hits = found.join(table.select(F.col("win").alias("bwin"), "ids"), F.col("win") == F.col("bwin"))
    # one list a different text, as long as the text's own hits
    hits = cut(hits.groupBy(F.col("text_key").alias("hkey")).agg(
        F.sort_array(F.array_distinct(F.flatten(F.collect_list(F.expr("sequence(pos, pos + size - 1)"))))).alias("hit_words"),
        F.sort_array(F.array_distinct(F.flatten(F.collect_set("ids")))).alias("items")), "benchmark-hits")

    def make():
        return lambda texts: ([len(words_of(t)) for t in texts],
                              [None if t is None else hashlib.sha256(t).hexdigest() for t in texts])

    cols = [f"k{i}" for i in range(len(keep))]
    out = map_text(docs, keep, make, "n_words bigint, text_key string", text=text).toDF(*cols, "n_words", "text_key")
    out = out.join(hits, F.col("text_key") == F.col("hkey"), "left")
    return out.select(*cols, "n_words", F.coalesce("hit_words", F.array().cast("array<int>")).alias("hit_words"),
                      F.coalesce("items", F.array().cast("array<string>")).alias("items")).toDF(
                          *keep, "n_words", "hit_words", "items")


def digest(scanned: DataFrame) -> DataFrame:
    """The count and digest columns of a scan."""
    ids = F.array_join("items", ",")
    return scanned.select(
        "doc_id", "n_words", F.size("hit_words").cast("long").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(ids.cast("binary"), 256).alias("items_sha256"),
        (F.size("hit_words") > 0).alias("contaminated"))


def cut_words(text: bytes | None, hit: list[int]) -> bytes | None:
    """The text without the runs of hit words (separators inside a run go, those around it stay)."""
    if not hit or text is None:
        return text
    spans = [m.span() for m in _WORD.finditer(text)]
    out, at, i = [], 0, 0
    while i < len(hit):
        j = i
        while j + 1 < len(hit) and hit[j + 1] == hit[j] + 1:
            j += 1
        out.append(text[at:spans[hit[i]][0]])
        at = spans[hit[j]][1]
        i = j + 1
    return b"".join([*out, text[at:]])


def decontaminate(docs: DataFrame, benchmark: DataFrame, mode: str = "document", n: int = WINDOW,
                  slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """``docs`` without contaminated documents (``mode='document'``) or without the hit spans (``'span'``).

    Columns and their order are those of ``docs``. In span mode ``n_chars``,
    if present, follows the new text.
    """
    cols = docs.columns
    inner = docs.toDF(*[f"c{i}" for i in range(len(cols))])
    at = f"c{cols.index('text')}"
    got = scan(inner, benchmark, inner.columns, n, slice_bytes, text=at)
    if mode == "document":
        return got.filter(F.size("hit_words") == 0).select(*inner.columns).toDF(*cols)
    if mode != "span":
        raise ValueError(f"mode is document or span, not {mode!r}")

    def make():
        return lambda texts, hits: ([None if t is None else cut_words(t, h).decode() for t, h in zip(texts, hits)],)

    got = map_text(got, inner.columns, make, "new_text string", text=at, extra=["hit_words"])
    new = {at: F.col("new_text")}
    if "n_chars" in cols:
        new[f"c{cols.index('n_chars')}"] = F.length("new_text").cast("long")
    return got.select(*[new.get(c, F.col(c)).alias(c) for c in inner.columns]).toDF(*cols)


def op3_decontaminate(spark, sf_dir):
    """Every document against every benchmark item, 10-word windows."""
    from riskloom.llm.common import read_table
    docs, bench = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")
    return digest(scan(docs, bench, ["doc_id"]))


def sha_of(items: list[str]) -> str:
    """The digest of a list of item ids, for tests."""
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
