"""Hard negatives by anchor spanning-tree bounds, exact for every anchor and row.

Every row's components become integers floor(256 x); a score is an integer
inner product with an anchor. The anchors of a block are joined into a
spanning tree of least total distance. For a row x with norm |x|, a child
anchor c of parent p has

    |score(c, x) - score(p, x)| <= |c - p| |x|,

so walking the tree from its root turns bounds at a parent into bounds at the
child. Only rows whose bounds reach what is asked for are scored again: the
best ``n_positives`` of the anchor's own label, then the best ``n_negatives``
of other labels inside each positive's window of scores. A row scored again
has exact bounds for the children below.

Rows and anchors are dealt by hash into blocks of bounded size, and every
block of rows meets every block of anchors once, in a task of its own: the
stated query set against all rows, in blocks. A task returns at most
``n_positives`` (or ``n_negatives`` a window) rows an anchor; the final
ranking is a window over those, cut to the same number on the map side.

Defined cases: a row with a null label, a null vector, or a null or
non-finite component takes no part; rows equal in id, label and vector count
once; a row is never a positive of an anchor with its own id; the shorter of
two vectors counts as padded with zeros; ties go to the smaller id, then to
the row hash; empty tables give empty results; other columns are never read,
their names do not matter. Scores are exact: doubles where they hold every
sum, whole numbers without a bound otherwise (a score beyond 64 bits raises
an error).
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm.common import cut, discard, read_table

ROW_BLOCK = 4096
ANCHOR_BLOCK = 2048
N_POSITIVES = 5
N_NEGATIVES = 3
#: negatives score between LOW and HIGH hundredths of the positive's score
LOW, HIGH = 50, 95
SCALE = 256.0


def usable(rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """(id, label, v, h) of the rows that take part: v is the integer vector as doubles, h tells rows of one id apart."""
    v = F.col(f"`{vector}`").cast("array<double>")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    out = rows.select(F.col(f"`{vec_id}`").alias("id"), F.col(f"`{label}`").cast("long").alias("label"), v.alias("v"), bad.alias("bad"))
    out = out.filter(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull() & ~F.col("bad"))
    # floor keeps whole doubles of any size, a cast to long would not
    whole = F.transform("v", lambda x: F.rint(x * SCALE) - F.when(F.rint(x * SCALE) > x * SCALE, 1.0).otherwise(0.0) + 0.0)
    out = out.select("id", "label", whole.alias("v"))
    return out.withColumn("h", F.xxhash64("label", "v")).dropDuplicates(["id", "label", "h"])


def matrix(vectors: pa.ChunkedArray) -> np.ndarray:
    """Rows of a list column as one matrix, shorter ones padded with zeros."""
    flat = vectors.combine_chunks()
    flat = flat.chunk(0) if isinstance(flat, pa.ChunkedArray) else flat
    sizes = np.diff(flat.offsets.to_numpy())
    width = int(sizes.max(initial=0))
    out = np.zeros((len(sizes), width))
    out[np.arange(width)[None, :] < sizes[:, None]] = flat.flatten().to_numpy(zero_copy_only=False)
    return out


def spanning_tree(v: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """(parent, edge length, order) of the least spanning tree, from row 0; parents come before their children, depth first."""
    n = len(v)
    parent, near = np.full(n, -1), np.full(n, np.inf)
    edge = np.zeros(n)
    norms = (v * v).sum(axis=1)
    left = np.ones(n, bool)
    at = 0
    for _ in range(n):
        left[at] = False
        d = np.sqrt(np.maximum(norms + norms[at] - 2 * (v @ v[at]), 0))
        closer = left & (d < near)
        near[closer], parent[closer] = d[closer], at
        if not left.any():
            break
        at = int(np.argmin(np.where(left, near, np.inf)))
    kids: dict[int, list[int]] = {}
    for i in range(1, n):
        kids.setdefault(int(parent[i]), []).append(i)
        edge[i] = np.sqrt(((v[i] - v[parent[i]]) ** 2).sum())
    order, stack = [], [0] if n else []
    while stack:
        i = stack.pop()
        order.append(i)
        stack += kids.get(i, [])
    return parent, edge, order


def anchor_trees(anchors: DataFrame, blocks: int) -> DataFrame:
    """The anchors with block, walk (place in the block's walk), up (the parent's place) and edge (the distance to it)."""
    kind = anchors.schema["id"].dataType.simpleString()

    def build(t: pa.Table) -> pa.Table:
        parent, edge, order = spanning_tree(matrix(t.column("v")))
        walk = np.empty(len(order), np.int64)
        walk[order] = np.arange(len(order))
        up = np.where(parent >= 0, walk[parent], -1)
        return (t.append_column("walk", pa.array(walk, pa.int32())).append_column("up", pa.array(up, pa.int32()))
                .append_column("edge", pa.array(edge)))
    dealt = anchors.withColumn("block", F.pmod(F.xxhash64("id", "h"), F.lit(blocks)).cast("int"))
    return dealt.groupBy("block").applyInArrow(
        build, f"id {kind}, label bigint, v array<double>, h bigint, block int, walk int, up int, edge double")


class Scorer:
    """Scores of a block of rows along a tree of anchors: bounds for all rows, exact scores where asked."""

    def __init__(self, x: np.ndarray, a: np.ndarray):
        width = max(x.shape[1], a.shape[1])
        x, a = (np.pad(m, ((0, 0), (0, width - m.shape[1]))) for m in (x, a))
        exact = width * float(np.abs(x).max(initial=0)) * float(np.abs(a).max(initial=0)) < 2.0 ** 52
        self.x, self.a = (x, a) if exact else (_whole(x), _whole(a))
        self.exact = exact
        self.norm = np.sqrt((x * x).sum(axis=1)) * (1 + 1e-9)
        self.bounds: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.rescored = 0

    def reach(self, i: int, up: int, edge: float) -> tuple[np.ndarray, np.ndarray]:
        """Lower and upper bounds of every row's score at anchor ``i``."""
        if up < 0 or not self.exact:
            lo = hi = self._score(i, slice(None))
        else:
            w = self.norm * (edge * (1 + 1e-9)) + 1e-6
            lo, hi = self.bounds[up]
            lo, hi = lo - w, hi + w
        return lo, hi

    def _score(self, i: int, which) -> np.ndarray:
        return self.x[which] @ self.a[i]

    def settle(self, i: int, lo: np.ndarray, hi: np.ndarray, need: np.ndarray, keep: bool) -> np.ndarray:
        """Exact scores of the rows ``need`` (indices); with ``keep`` the bounds stay for the anchor's children."""
        if lo is hi:
            s = lo[need]
        else:
            self.rescored += len(need)
            s = (self._score(i, slice(None))[need] if len(need) > len(lo) // 2 else self._score(i, need))
            if keep:
                lo[need] = hi[need] = s
        if keep:
            self.bounds[i] = lo, hi
        return s


def _whole(m: np.ndarray) -> np.ndarray:
    out = np.empty(m.shape, object)
    out[...] = [[int(c) for c in r] for r in m]
    return out


def _kth(values: np.ndarray, k: int):
    """The k-th largest value, or -inf where there are fewer."""
    if len(values) < k:
        return -np.inf
    return np.sort(values)[-k] if values.dtype == object else np.partition(values, -k)[-k]


def _walk(t: pa.Table):
    """The anchors of a block in the order of the walk, and the last child of each."""
    t = t.sort_by("walk")
    up = t.column("up").to_numpy()
    last = np.full(len(up), -1)
    last[up[up >= 0]] = np.flatnonzero(up >= 0)     # places ascend, so the last child stays
    return t, up, t.column("edge").to_numpy(), last


def _best(score, ids, hashes, k: int) -> list[int]:
    """Places of the k best by score (descending), id and hash."""
    if len(score) > 64 and score.dtype != object:
        t = _kth(score, k)
        cand = np.flatnonzero(score >= t)
    else:
        cand = np.arange(len(score))
    return sorted(cand.tolist(), key=lambda j: (-score[j], ids[j], hashes[j]))[:k]


def _blocks(rows: DataFrame, anchors: DataFrame, groups: int, blocks: int, work, schema: str) -> DataFrame:
    """Every block of rows with every block of anchors, a task each."""
    dealt = rows.withColumn("grp", F.pmod(F.xxhash64("h", "id"), F.lit(groups)).cast("int")) \
        .withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    tiled = anchors.withColumn("grp", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    return dealt.groupBy("grp", "block").cogroup(tiled.groupBy("grp", "block")).applyInArrow(work, schema)


def positives(rows: DataFrame, trees: DataFrame, groups: int, blocks: int, n: int = N_POSITIVES) -> DataFrame:
    """(anchor, anchor_h, positive, positive_h, score): each anchor's n best other rows of its label."""
    kind = rows.schema["id"].dataType.simpleString()
    out_schema = pa.schema([("anchor", pa.int64()), ("anchor_h", pa.int64()), ("positive", pa.int64()), ("positive_h", pa.int64()), ("score", pa.int64())])

    def work(left: pa.Table, right: pa.Table) -> pa.Table:
        out = [[] for _ in range(5)]
        if left.num_rows and right.num_rows:
            t, up, edge, last = _walk(right)
            ids, hs, labels = (left.column(c).to_numpy() for c in ("id", "h", "label"))
            a_id, a_h, a_label = (t.column(c).to_numpy() for c in ("id", "h", "label"))
            s = Scorer(matrix(left.column("v")), matrix(t.column("v")))
            for i in range(len(up)):
                lo, hi = s.reach(i, up[i], edge[i])
                own = np.flatnonzero((labels == a_label[i]) & (ids != a_id[i]))
                need = own[hi[own] >= _kth(lo[own], n)] if len(own) >= n else own
                score = s.settle(i, lo, hi, need, last[i] > 0)
                if up[i] >= 0 and last[up[i]] == i:
                    s.bounds.pop(up[i], None)
                for j in _best(score, ids[need], hs[need], n):
                    for c, x in zip(out, (a_id[i], a_h[i], ids[need[j]], hs[need[j]], int(score[j]))):
                        c.append(x)
        return pa.table(out, out_schema)
    got = _blocks(rows, trees, groups, blocks, work,
                  f"anchor {kind}, anchor_h bigint, positive {kind}, positive_h bigint, score bigint")
    by = Window.partitionBy("anchor", "anchor_h").orderBy(F.desc("score"), "positive", "positive_h")
    return got.withColumn("place", F.row_number().over(by)).filter(F.col("place") <= n)


def negatives(rows: DataFrame, trees: DataFrame, groups: int, blocks: int, n: int = N_NEGATIVES,
              low: int = LOW, high: int = HIGH) -> DataFrame:
    """(anchor, anchor_h, place, negative, score, rank): the n best rows of other labels in each window.

    ``trees`` carries ``windows``: an array of (place, score) of the anchor's positives.
    """
    kind = rows.schema["id"].dataType.simpleString()
    out_schema = pa.schema([("anchor", pa.int64()), ("anchor_h", pa.int64()), ("place", pa.int32()), ("negative", pa.int64()), ("negative_h", pa.int64()), ("score", pa.int64())])

    def work(left: pa.Table, right: pa.Table) -> pa.Table:
        out = [[] for _ in range(6)]
        if left.num_rows and right.num_rows:
            t, up, edge, last = _walk(right)
            ids, hs, labels = (left.column(c).to_numpy() for c in ("id", "h", "label"))
            a_id, a_h, a_label = (t.column(c).to_numpy() for c in ("id", "h", "label"))
            windows = t.column("windows").to_pylist()
            s = Scorer(matrix(left.column("v")), matrix(t.column("v")))
            for i in range(len(up)):
                lo, hi = s.reach(i, up[i], edge[i])
                # whole scores n with low * p <= 100 * n <= high * p
                spans = [(w["place"], -(-low * w["score"] // 100), high * w["score"] // 100) for w in windows[i] or ()]
                spans = [w for w in spans if w[1] <= w[2]]
                other = labels != a_label[i]
                need = np.zeros(len(ids), bool)
                for _, least, most in spans:
                    touch = other & (hi >= least) & (lo <= most)
                    sure = touch & (lo >= least) & (hi <= most)
                    need |= touch & (hi >= _kth(lo[sure], n)) if sure.sum() >= n else touch
                at = np.flatnonzero(need)
                score = s.settle(i, lo, hi, at, last[i] > 0)
                if up[i] >= 0 and last[up[i]] == i:
                    s.bounds.pop(up[i], None)
                for place, least, most in spans:
                    fit = np.flatnonzero((score >= least) & (score <= most))
                    for j in _best(score[fit], ids[at[fit]], hs[at[fit]], n):
                        r = at[fit[j]]
                        for c, x in zip(out, (a_id[i], a_h[i], place, ids[r], hs[r], int(score[fit[j]]))):
                            c.append(x)
        return pa.table(out, out_schema)
    got = _blocks(rows, trees, groups, blocks, work,
                  f"anchor {kind}, anchor_h bigint, place int, negative {kind}, negative_h bigint, score bigint")
    by = Window.partitionBy("anchor", "anchor_h", "place").orderBy(F.desc("score"), "negative", "negative_h")
    return got.withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= n)


def mine(rows: DataFrame, is_anchor: Column, n_positives: int = N_POSITIVES, n_negatives: int = N_NEGATIVES,
         low: int = LOW, high: int = HIGH, row_block: int = ROW_BLOCK, anchor_block: int = ANCHOR_BLOCK) -> DataFrame:
    """Hard negatives of the anchors among ``rows`` (from ``usable``, whole-number ids).

    Returns anchor_id, positive_id, rank, negative_id, positive_score, negative_score.
    """
    rows = cut(rows.select(F.col("id").cast("long").alias("id"), "label", "v", "h"), "vectors")
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.count(F.when(is_anchor, 1)).alias("a")).first()
    groups, blocks = max(1, math.ceil(size["n"] / row_block)), max(1, math.ceil(size["a"] / anchor_block))
    trees = cut(anchor_trees(rows.filter(is_anchor), blocks), "anchor-trees")
    pos = cut(positives(rows, trees, groups, blocks, n_positives), "positives")
    windows = pos.groupBy("anchor", "anchor_h").agg(F.collect_list(F.struct("place", "score")).alias("windows"))
    # anchors without positives stay in the tree, without windows
    asked = trees.join(windows, (F.col("id") == F.col("anchor")) & (F.col("h") == F.col("anchor_h")), "left")
    asked = cut(asked.drop("anchor", "anchor_h"), "windows")
    neg = negatives(rows, asked, groups, blocks, n_negatives, low, high)
    out = neg.withColumnRenamed("score", "negative_score").join(
        pos.withColumnRenamed("score", "positive_score"), ["anchor", "anchor_h", "place"])
    got = cut(out.select(F.col("anchor").alias("anchor_id"), F.col("positive").alias("positive_id"), "rank",
                         F.col("negative").alias("negative_id"), "positive_score", "negative_score"), "hard-negatives")
    discard(rows, trees, pos, asked)
    return got


def op12_hard_negatives(spark, sf_dir):
    """Hard negatives of every 50th vector against all vectors."""
    table = read_table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = usable(table.select("vec_id", "embedding", moved.alias("label")))
    return mine(rows, F.col("id") % 50 == 0)
