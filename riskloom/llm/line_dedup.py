"""Reversible line dedup: sharded cuckoo filters over exact reference-count tables.

``LineIndex`` keeps, in a shared folder,

* ``holders``: one row (key, document, row) per different line key of a row;
* ``counts``: exact reference counts, one row (key, refs, first document) per key;
* ``filters``: one cuckoo filter a shard of the key space, holding a
  16-bit fingerprint of every key of ``counts``.

``insert`` sums the batch by key, sends every key once to its shard and asks
the shard's filter there. A key that the filter does not know is new: it goes
to the counts as it is and its fingerprint into the filter. Only keys that
the filter may know are joined with the stored counts. ``delete`` subtracts
the holders of the deleted documents, finds the next smallest document of
keys that lost their first one, and takes the fingerprints of keys without
references out again, so a deletion undoes an insertion. ``keep`` drops every
line whose key has two or more documents, except in the first one.

Keys are 128-bit hashes (MD5) of the normalised line: equal hashes are taken
as equal lines, wrong by chance at n^2 / 2^129 for n different lines. All
rows are dealt by key and document or once per different key, so a line in a third of all
documents is no hot key; joins on the key leave the holders' side to the
skew join. A shard's filter and keys are one task's work: shards are sized
from the row count, ``SHARD_KEYS`` keys each.

Defined cases: a null or empty text is one empty line; rows that share an id
are one document (each keeps its own text); null ids are one document, after
all others; a document already in the index is not inserted again; an empty
table gives an empty index and result; other columns are never read, their
names do not matter.
"""

from __future__ import annotations

import hashlib
import math
import os
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm.common import ASCII_SPACE, LOWER_TABLE, map_text, read_table
from riskloom.session import checkpoint_dir

MIN_CHARS = 10
SHARD_KEYS = 100_000
MIN_SHARDS = 64
SLOTS = 4
MAX_LOAD = 0.75
_CONTINUATION = bytes(range(0x80, 0xC0))


def normal(line: bytes) -> bytes:
    return line.strip(ASCII_SPACE).translate(LOWER_TABLE)


def line_keys(text: bytes | None, min_chars: int = MIN_CHARS) -> list[bytes | None]:
    """The 16-byte key of each line; None where the normalised line is under ``min_chars`` code points."""
    out = []
    for line in (text or b"").split(b"\n"):
        k = normal(line)
        enough = len(k) >= min_chars and (k.isascii() or len(k.translate(None, _CONTINUATION)) >= min_chars)
        out.append(hashlib.md5(k).digest() if enough else None)
    return out


# --- cuckoo filter -----------------------------------------------------------

class CuckooFilter:
    """Partial-key cuckoo filter: four 16-bit slots a bucket, two buckets a fingerprint.

    Works on arrays of keys. The partner bucket follows from the bucket and
    the fingerprint, so entries move without their key. A fingerprint is held
    once per inserted key: equal fingerprints of one bucket pair are held
    several times, and a deletion takes one of them out.
    """

    def __init__(self, table: np.ndarray):
        self.table = table                      # (buckets, SLOTS) uint16, 0 is free
        self.mask = np.uint64(len(table) - 1)

    @classmethod
    def sized(cls, keys: int) -> CuckooFilter:
        buckets = 1 << max(2, math.ceil(math.log2(max(1, keys) / (SLOTS * MAX_LOAD))))
        return cls(np.zeros((buckets, SLOTS), np.uint16))

    @classmethod
    def load(cls, data: bytes) -> CuckooFilter:
        return cls(np.frombuffer(data, np.uint16).reshape(-1, SLOTS).copy())

    def dump(self) -> bytes:
        return self.table.tobytes()

    @property
    def held(self) -> int:
        return int(np.count_nonzero(self.table))

    def fits(self, more: int) -> bool:
        return self.held + more <= MAX_LOAD * self.table.size

    def places(self, k1: np.ndarray, k2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bucket, fingerprint) of each key."""
        a, b = k1.astype(np.int64).view(np.uint64), k2.astype(np.int64).view(np.uint64)
        fp = (b % np.uint64(65535)).astype(np.uint16) + np.uint16(1)
        return ((a >> np.uint64(20)) ^ (b << np.uint64(7))) & self.mask, fp

    def partner(self, bucket: np.ndarray, fp: np.ndarray) -> np.ndarray:
        return bucket ^ ((fp.astype(np.uint64) * np.uint64(0x5BD1E9955BD1E995) >> np.uint64(17)) & self.mask)

    def contains(self, k1: np.ndarray, k2: np.ndarray) -> np.ndarray:
        b, fp = self.places(k1, k2)
        near = (self.table[b.astype(np.int64)] == fp[:, None]).any(axis=1)
        return near | (self.table[self.partner(b, fp).astype(np.int64)] == fp[:, None]).any(axis=1)

    def _fill(self, bucket: np.ndarray, fp: np.ndarray) -> np.ndarray:
        """Put what fits into free slots; returns True where it did."""
        b = bucket.astype(np.int64)
        order = np.argsort(b, kind="stable")
        sb = b[order]
        first = np.r_[True, sb[1:] != sb[:-1]] if len(sb) else np.zeros(0, bool)
        turn = np.arange(len(sb)) - np.flatnonzero(first)[np.cumsum(first) - 1] if len(sb) else sb
        free = self.table[sb] == 0
        room = free.sum(axis=1)
        take = turn < room
        # the turn-th free slot of the bucket
        slot = np.argmax((np.cumsum(free, axis=1) == (turn + 1)[:, None]) & free, axis=1)
        self.table[sb[take], slot[take]] = fp[order][take]
        done = np.zeros(len(b), bool)
        done[order] = take
        return done

    def insert(self, k1: np.ndarray, k2: np.ndarray) -> CuckooFilter:
        """This filter with the keys in it; call ``fits`` first. Entries that find both buckets full evict others."""
        b, fp = self.places(k1, k2)
        left = ~self._fill(b, fp)
        b, fp = self.partner(b[left], fp[left]), fp[left]
        rng = np.random.default_rng(len(k1))
        for _ in range(500):
            left = ~self._fill(b, fp)
            b, fp = b[left], fp[left]
            if not len(b):
                return self
            # one entry a bucket evicts a random slot and the evicted one goes to its partner
            _, one = np.unique(b, return_index=True)
            at, slot = b[one].astype(np.int64), rng.integers(0, SLOTS, len(one))
            out = self.table[at, slot].copy()
            self.table[at, slot] = fp[one]
            b[one], fp[one] = self.partner(b[one], out), out
        raise OverflowError("cuckoo filter is full")

    def delete(self, k1: np.ndarray, k2: np.ndarray) -> CuckooFilter:
        """Take one fingerprint a key out. Only keys that were inserted may be deleted."""
        b, fp = self.places(k1, k2)
        for i, other, f in zip(b.tolist(), self.partner(b, fp).tolist(), fp.tolist()):
            for j in (i, other):
                at = np.flatnonzero(self.table[j] == f)
                if len(at):
                    self.table[j, at[0]] = 0
                    break
        return self


# --- rows and shards -----------------------------------------------------------

def holders_of(docs: DataFrame, id_col: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS) -> DataFrame:
    """(k1, k2, doc, row): the different keys of every row. ``row`` tells rows of one id apart by their text."""
    rows = docs.select(F.col(f"`{id_col}`").alias("doc"), F.xxhash64(F.col(f"`{text}`")).alias("row"),
                       F.col(f"`{text}`").cast("string").cast("binary").alias("t"))
    kind = rows.schema["doc"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at, keys = [], []

            def flush():
                half = np.frombuffer(b"".join(keys), np.int64).reshape(-1, 2)
                idx = pa.array(np.array(at, np.int64))
                return pa.RecordBatch.from_arrays(
                    [pa.array(half[:, 0]), pa.array(half[:, 1]), b.column(0).take(idx), b.column(1).take(idx)],
                    ["k1", "k2", "doc", "row"])
            for i in range(b.num_rows):
                own = set(line_keys(b.column(2)[i].as_py(), min_chars))
                own.discard(None)
                keys += own
                at += [i] * len(own)
                if len(at) >= 50_000:
                    yield flush()
                    at, keys = [], []
            if at:
                yield flush()
    return rows.mapInArrow(run, f"k1 bigint, k2 bigint, doc {kind.simpleString()}, row bigint")


def filter_row(shard: int, f: CuckooFilter) -> pa.Table:
    return pa.table({"shard": [shard], "data": [f.dump()]}, pa.schema([("shard", pa.int32()), ("data", pa.binary())]))


class LineIndex:
    """Line holders, reference counts and cuckoo filters of a growing set of documents, in a shared folder.

    Every change writes tables beside the old ones and then moves on to them;
    a change that dies midway leaves the index as it was.
    """

    def __init__(self, spark: SparkSession, path: str | None = None, id_col: str = "doc_id", text: str = "text",
                 min_chars: int = MIN_CHARS, shard_keys: int = SHARD_KEYS):
        self.spark, self.id_col, self.text, self.min_chars, self.shard_keys = spark, id_col, text, min_chars, shard_keys
        self.path = path or os.path.join(checkpoint_dir(spark), "riskloom-tables", f"lines-{uuid.uuid4().hex}")
        self.shards = 0
        self.holders_at: list[str] = []
        self.counts_at = self.filters_at = ""

    def _write(self, name: str, df: DataFrame) -> str:
        at = os.path.join(self.path, f"{name}-{uuid.uuid4().hex}")
        df.write.parquet(at)
        return at

    def _drop(self, *paths: str) -> None:
        sc = self.spark.sparkContext
        for p in paths:
            if p:
                at = sc._jvm.org.apache.hadoop.fs.Path(p)
                at.getFileSystem(sc._jsc.hadoopConfiguration()).delete(at, True)

    @property
    def holders(self) -> DataFrame:
        return self.spark.read.parquet(*self.holders_at)

    @property
    def counts(self) -> DataFrame:
        return self.spark.read.parquet(self.counts_at)

    @property
    def filters(self) -> DataFrame:
        return self.spark.read.parquet(self.filters_at)

    def close(self) -> None:
        """Delete the whole index."""
        self._drop(self.path)

    def insert(self, docs: DataFrame) -> LineIndex:
        """Add documents; those whose id the index already holds are left as they are."""
        batch = holders_of(docs, self.id_col, self.text, self.min_chars)
        if self.holders_at:
            known = self.holders.select(F.col("doc").alias("known")).distinct()
            batch = batch.join(known, F.col("doc").eqNullSafe(F.col("known")), "left_anti")
        at = self._write("holders", batch)
        batch = self.spark.read.parquet(at)
        sums = _by_key(batch)
        if not self.shards:
            self.shards = max(MIN_SHARDS, math.ceil(batch.count() / self.shard_keys))
        if not self.counts_at:
            self.counts_at = self._write("counts", sums)
            self.filters_at = self._write("filters", self._built(self.counts))
            self.holders_at = [at]
            return self
        asked_at = self._write("asked", self._ask(sums))
        asked = self.spark.read.parquet(asked_at)
        maybe = asked.filter("maybe").select("k1", "k2", F.col("refs").alias("r"), F.col("first").alias("f"))
        # keys that the filter may know: exact join; a false alarm finds no partner and is new after all
        joined = self.counts.join(maybe, ["k1", "k2"], "full_outer").select(
            "k1", "k2", (F.coalesce("refs", F.lit(0)) + F.coalesce("r", F.lit(0))).alias("refs"),
            F.least("first", "f").alias("first"))
        counts_at = self._write("counts", joined.unionByName(
            asked.filter("not maybe").select("k1", "k2", "refs", "first")))
        alarms = asked.filter("maybe").join(self.counts.select("k1", "k2"), ["k1", "k2"], "left_anti")
        fresh = asked.filter("not maybe").select("shard", "k1", "k2").unionByName(alarms.select("shard", "k1", "k2"))
        filters_at = self._write("filters", self._changed(fresh, self.spark.read.parquet(counts_at), delete=False))
        old = (self.counts_at, self.filters_at, asked_at)
        self.counts_at, self.filters_at = counts_at, filters_at
        self.holders_at = [*self.holders_at, at]
        self._drop(*old)
        return self

    def _ask(self, sums: DataFrame) -> DataFrame:
        """Every key of the batch, once, with ``maybe``: its shard's filter may know it."""
        keys = self._sharded(sums, "refs", "first")

        def ask(left: pa.Table, right: pa.Table) -> pa.Table:
            known = np.zeros(left.num_rows, bool)
            if left.num_rows and right.num_rows:
                f = CuckooFilter.load(right.column("data")[0].as_py())
                known = f.contains(left.column("k1").to_numpy(), left.column("k2").to_numpy())
            return left.append_column("maybe", pa.array(known))
        kind = sums.schema["first"].dataType.simpleString()
        return keys.groupBy("shard").cogroup(self.filters.groupBy("shard")).applyInArrow(
            ask, f"shard int, k1 bigint, k2 bigint, refs bigint, first {kind}, maybe boolean")

    def _sharded(self, keys: DataFrame, *more: str) -> DataFrame:
        return keys.select(F.pmod(F.col("k1"), F.lit(self.shards)).cast("int").alias("shard"), "k1", "k2", *more)

    def _built(self, counts: DataFrame) -> DataFrame:
        """One filter a shard over all keys of the counts."""
        def build(t: pa.Table) -> pa.Table:
            f = CuckooFilter.sized(t.num_rows).insert(t.column("k1").to_numpy(), t.column("k2").to_numpy())
            return filter_row(t.column("shard")[0].as_py(), f)
        return self._sharded(counts).groupBy("shard").applyInArrow(build, "shard int, data binary")

    def _changed(self, keys: DataFrame, counts: DataFrame, delete: bool) -> DataFrame:
        """The filters with ``keys`` put in or taken out; a shard without room is built anew from its counts."""
        old = self.filters.select("shard", F.lit(None).cast("long").alias("k1"), F.lit(None).cast("long").alias("k2"), "data")
        rows = keys.withColumn("data", F.lit(None).cast("binary")).unionByName(old)

        def apply(left: pa.Table, right: pa.Table) -> pa.Table:
            data = [x for x in left.column("data").to_pylist() if x is not None]
            own = left.filter(pc.is_valid(left.column("k1")))
            k1, k2 = own.column("k1").to_numpy(), own.column("k2").to_numpy()
            f = CuckooFilter.load(data[0]) if data else CuckooFilter.sized(0)
            if delete:
                f.delete(k1, k2)
            elif f.fits(len(k1)):
                f.insert(k1, k2)
            else:
                f = CuckooFilter.sized(2 * right.num_rows).insert(
                    right.column("k1").to_numpy(), right.column("k2").to_numpy())
            return filter_row((left if left.num_rows else right).column("shard")[0].as_py(), f)
        return rows.groupBy("shard").cogroup(self._sharded(counts).groupBy("shard")).applyInArrow(
            apply, "shard int, data binary")

    def delete(self, ids: DataFrame) -> LineIndex:
        """Take documents out again, by id; ids that the index does not hold change nothing."""
        if not self.holders_at:
            return self
        gone = ids.select(F.col(f"`{self.id_col}`").alias("gone")).distinct()
        match = F.col("doc").eqNullSafe(F.col("gone"))
        out_at = self._write("out", self.holders.join(gone, match, "left_semi"))
        out = self.spark.read.parquet(out_at)
        holders_at = self._write("holders", self.holders.join(gone, match, "left_anti"))
        left = self.spark.read.parquet(holders_at)
        lost = _by_key(out).select("k1", "k2", F.col("refs").alias("r"), F.col("first").alias("f"))
        # the next smallest document is asked for only where the first one went
        heads = self.counts.join(lost, ["k1", "k2"]).filter((F.col("refs") > F.col("r")) & F.col("first").eqNullSafe(F.col("f")))
        nexts = _by_key(left.join(heads.select("k1", "k2"), ["k1", "k2"], "left_semi")).select(
            "k1", "k2", F.col("first").alias("next"), F.lit(True).alias("moved"))
        joined = self.counts.join(lost, ["k1", "k2"], "left").join(nexts, ["k1", "k2"], "left")
        counts_at = self._write("counts", joined.select(
            "k1", "k2", (F.col("refs") - F.coalesce("r", F.lit(0))).alias("refs"),
            F.when(F.col("moved"), F.col("next")).otherwise(F.col("first")).alias("first")).filter("refs > 0"))
        counts = self.spark.read.parquet(counts_at)
        dead = self._sharded(self.counts.join(counts, ["k1", "k2"], "left_anti"))
        filters_at = self._write("filters", self._changed(dead, counts, delete=True))
        old = (*self.holders_at, self.counts_at, self.filters_at, out_at)
        self.holders_at, self.counts_at, self.filters_at = [holders_at], counts_at, filters_at
        self._drop(*old)
        return self

    def dropped(self) -> DataFrame:
        """(doc, row, keys): the keys that a row loses, for rows that lose any."""
        twice = self.counts.filter("refs > 1").select("k1", "k2", "first")
        lose = self.holders.join(twice, ["k1", "k2"]).filter(~F.col("doc").eqNullSafe(F.col("first")))
        return lose.groupBy("doc", "row").agg(F.collect_set(F.struct("k1", "k2")).alias("keys"))

    def keep(self, docs: DataFrame) -> DataFrame:
        """Id, n_lines, n_dropped and kept (the text without its dropped lines) of indexed documents."""
        lose = self.dropped().select(F.col("doc").alias("_d"), F.col("row").alias("_r"),
                                     F.col("keys.k1").alias("_k1"), F.col("keys.k2").alias("_k2"))
        base = docs.select(F.col(f"`{self.id_col}`").alias("doc"), F.col(f"`{self.text}`").alias("text"))
        rows = base.join(lose, F.col("doc").eqNullSafe(F.col("_d")) & (F.xxhash64("text") == F.col("_r")), "left")
        min_chars = self.min_chars

        def make():
            def f(texts, k1s, k2s):
                n_lines, n_dropped, kept = [], [], []
                for t, a, b in zip(texts, k1s, k2s):
                    lines = (t or b"").split(b"\n")
                    n_lines.append(len(lines))
                    if a:
                        half = np.array([a, b], np.int64).T.tobytes()
                        lose = {half[i:i + 16] for i in range(0, len(half), 16)}
                        stay = [x for x, k in zip(lines, line_keys(t, min_chars)) if k not in lose]
                    else:
                        stay = lines
                    n_dropped.append(len(lines) - len(stay))
                    kept.append(b"\n".join(stay).decode())
                return [n_lines, n_dropped, kept]
            return f
        out = map_text(rows, ["doc"], make, "n_lines bigint, n_dropped bigint, kept string", extra=["_k1", "_k2"])
        return out.withColumnRenamed("doc", self.id_col)


def _by_key(holders: DataFrame) -> DataFrame:
    """(k1, k2, refs, first): documents a key, each once; the first is the smallest id, null after all others."""
    once = holders.groupBy("k1", "k2", "doc").agg(F.lit(1).alias("one"))
    return once.groupBy("k1", "k2").agg(F.count(F.lit(1)).alias("refs"), F.min("doc").alias("first"))


def op11_line_dedup(spark, sf_dir):
    """Line dedup of all documents: an index loaded in two parts, the second one through the filters of the first."""
    docs = read_table(spark, sf_dir, "documents")
    part = F.pmod(F.xxhash64("doc_id"), F.lit(2))
    index = LineIndex(spark).insert(docs.filter(part == 0)).insert(docs.filter(part == 1))
    got = index.keep(docs)
    return got.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))
