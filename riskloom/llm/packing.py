"""Token ids packed into fixed-width rows: best-fit-decreasing with a capacity segment tree.

Every text becomes token ids; a text longer than the row width is cut into
segments of that width, the rest is one more segment, so nothing is lost.
Segments of a packing group are placed longest first into the fullest row
that still has room; a segment tree over the free capacities finds that row
in O(log width). A row of the output holds the padded ids (little-endian
uint16 or uint32), the cumulative segment lengths and, per segment, its
document, the position in the document at which it starts, and the offsets
at which positions are reset to 0.

Packing works on groups of at most ``group_tokens`` tokens of one input
split, in the order of the split: no shuffle, memory bounded by the group,
and a task that is run again gives the same rows. Only the last rows of a
group can be loosely filled.

The tokenizer is byte-level and lossless; its file is a parameter.

Defined cases: null and empty texts have no tokens and no segment; repeated
rows are packed each for itself; a null doc_id is kept as null; ties in
length keep the order of the split; an empty table gives no rows.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import read_table

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
WIDTH = 2048
GROUP_TOKENS = 8 << 20
SCHEMA = ("ids binary, n_tokens int, cu_seqlens array<int>, doc_ids array<bigint>, seg_starts array<bigint>, "
          "position_resets array<int>")


class CapacityTree:
    """Counts of rows by free capacity; finds the smallest capacity that is large enough."""

    def __init__(self, width: int) -> None:
        self.size = 1 << width.bit_length()
        self.count = [0] * (2 * self.size)

    def add(self, capacity: int, by: int) -> None:
        i = capacity + self.size
        while i:
            self.count[i] += by
            i >>= 1

    def best(self, need: int) -> int:
        """Smallest capacity >= need with a row, or -1."""
        i = need + self.size
        if self.count[i]:
            return need
        while i > 1:
            if not i & 1 and self.count[i + 1]:  # a left child whose sibling has rows
                i += 1
                break
            i >>= 1
        else:
            return -1
        while i < self.size:
            i = 2 * i if self.count[2 * i] else 2 * i + 1
        return i - self.size


def best_fit_decreasing(lengths: list[int], width: int) -> list[list[int]]:
    """Segments (by index) of every row; each length is within 1..width."""
    rows: list[list[int]] = []
    open_: list[list[int]] = [[] for _ in range(width + 1)]  # row numbers by free capacity
    tree = CapacityTree(width)
    for i in sorted(range(len(lengths)), key=lambda j: -lengths[j]):  # stable: ties in given order
        room = tree.best(lengths[i])
        if room < 0:
            r, room = len(rows), width
            rows.append([])
        else:
            r = open_[room].pop()
            tree.add(room, -1)
        rows[r].append(i)
        left = room - lengths[i]
        if left:
            open_[left].append(r)
            tree.add(left, 1)
    return rows


@lru_cache(maxsize=1)
def load_encoding(path: str):
    """The tiktoken encoding of a rank file, with the standard split pattern of byte-level BPE."""
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    pattern = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"
    return tiktoken.Encoding(os.path.basename(path), pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def pack_group(segments: list[tuple], width: int, pad: int, dtype) -> Iterator[tuple]:
    """Rows of one group; a segment is (doc_id, start in the document, ids)."""
    for row in best_fit_decreasing([len(s[2]) for s in segments], width):
        ids = np.full(width, pad, dtype)
        ends, at = [0], 0
        for i in row:
            part = segments[i][2]
            ids[at:at + len(part)] = part
            at += len(part)
            ends.append(at)
        yield (ids.tobytes(), at, ends, [segments[i][0] for i in row], [segments[i][1] for i in row], ends[:-1])


def pack(docs: DataFrame, tokenizer: str = TOKENIZER, width: int = WIDTH, group_tokens: int = GROUP_TOKENS,
         pad: int | None = None) -> DataFrame:
    """Packed rows of all texts of ``docs`` (doc_id, text); ``pad`` is the first free id if not given."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = load_encoding(tokenizer)
        fill = enc.n_vocab if pad is None else pad
        dtype = np.dtype("<u2" if max(enc.n_vocab, fill) < 1 << 16 else "<u4")
        names = ["ids", "n_tokens", "cu_seqlens", "doc_ids", "seg_starts", "position_resets"]
        types = [pa.binary(), pa.int32(), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.int64()),
                 pa.list_(pa.int32())]

        def flush(segments):
            chunk = []
            for r in pack_group(segments, width, fill, dtype):
                chunk.append(r)
                if len(chunk) == 1024:
                    yield batch(chunk)
                    chunk = []
            if chunk:
                yield batch(chunk)

        def batch(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(zip(*rows), types)], names)

        segments, held = [], 0
        for b in batches:
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1)):
                text = text.as_py()
                if not text:
                    continue
                ids = np.array(enc.encode_ordinary(text), dtype)
                for i in range(0, len(ids), width):
                    part = ids[i:i + width]
                    if held + len(part) > group_tokens and segments:
                        yield from flush(segments)
                        segments, held = [], 0
                    segments.append((doc_id, i, part))
                    held += len(part)
        if segments:
            yield from flush(segments)

    flat = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return flat.mapInArrow(run, SCHEMA)


def unpack(ids: bytes, cu_seqlens: list[int], doc_ids: list[int], seg_starts: list[int], itemsize: int = 2):
    """[(doc_id, start, ids)] of one packed row: the inverse of ``pack_group``."""
    a = np.frombuffer(ids, "<u2" if itemsize == 2 else "<u4")
    return [(d, s, a[x:y]) for d, s, x, y in zip(doc_ids, seg_starts, cu_seqlens, cu_seqlens[1:])]


def op10_packing(spark, sf_dir):
    """All documents as packed rows of 2,048 token ids."""
    return pack(read_table(spark, sf_dir, "documents"))
