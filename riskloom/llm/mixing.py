"""Mixing sources to target weights with hash-threshold histograms.

Every row has a 64-bit hash of its id and text. The words of a source are
summed by the top bits of that hash; the bucket in which the running sum
passes the budget is the boundary, and only the rows of the boundary bucket
are summed again by the next bits, until it holds one hash value. A row is
taken when its hash lies below the threshold: no sort, and thresholds are
nested, a smaller budget takes a subset of a larger one.

A source with weight beyond its words is repeated: whole epochs of every
row, then one more copy of the rows below the threshold. Targets share the
total by weight; none may exceed ``max_epochs`` times its source, the excess
is shared again by weight among the others until none is above.

Defined cases: a null text has size 0; a null source is a source of its own,
after all others; a source without words has target 0; equal rows share a
hash, and where it is the boundary, as many of them are taken as come nearest
to the target; an empty table gives an empty mix.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm.common import bounded_broadcast, cut, read_table

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
BITS = 12
_MIN = -(1 << 63)


def word_count(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def ordered_hash(*cols: Column) -> Column:
    """A 64-bit row hash as a long whose signed order is the hash's unsigned order."""
    return F.xxhash64(*cols).bitwiseXOR(F.lit(_MIN))


def source_weights(sizes: DataFrame, weights=WEIGHTS) -> DataFrame:
    """One row per source: rank by code point (null last), weight, size. Sources, not rows, are numbered."""
    from riskloom.operators.reshape import add_dense_id

    by = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("rows"))
    keyed = by.select(F.col("source").isNull().alias("is_null"), F.coalesce("source", F.lit("")).alias("name"),
                      "source", "source_size", "rows")
    ranked = add_dense_id(keyed, ["is_null", "name"], "rank")
    pick = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.col("rank") - 1) % len(weights) + 1).cast("int"))
    return ranked.select("source", "source_size", "rows", "rank", pick.alias("weight"))


def with_targets(sources: DataFrame, max_epochs: int = MAX_EPOCHS, share: float = 1.0) -> DataFrame:
    """Water-filling: shares by weight, capped at ``max_epochs`` times the source, excess shared again.

    Each round is one aggregate over the sources that returns three numbers.
    """
    src = sources.withColumn("full", F.lit(False))
    most = F.col("source_size") * float(max_epochs)
    total = float(src.agg(F.sum("source_size")).first()[0] or 0) * share
    level, full = 0.0, F.lit(False)
    while True:
        row = src.agg(F.sum(F.when(full, most).otherwise(0.0)), F.sum(F.when(full, 0.0).otherwise(F.col("weight"))),
                      F.sum(full.cast("int"))).first()
        if not row[1]:
            break
        level = (total - row[0]) / row[1]
        now = full | (F.col("weight") * F.lit(level) > most)
        if src.agg(F.sum(now.cast("int"))).first()[0] == row[2]:
            break
        # levels only rise, so the sources that are full stay full
        full = F.col("weight") * F.lit(level) > most
    return sources.withColumn("target", F.least(most, F.col("weight") * F.lit(level)))


def thresholds(rows: DataFrame, budgets: DataFrame, bits: int = BITS) -> DataFrame:
    """Per source the (shift, bucket, take_bucket, take_rows) threshold whose sum of ``size`` is nearest to ``budget``.

    ``rows``: source, h (ordered hash), size. ``budgets``: source, budget; at
    most one row per source. A row is below when ``h >> shift < bucket``, or
    ``= bucket`` with ``take_bucket``; ``take_rows`` is above 0 where only so many
    of the equal rows of the boundary are taken. Each level reads only the boundary
    bucket of the level before.
    """
    keep = None
    open_ = budgets.select("source", F.col("budget").cast("double").alias("left"))
    shift, inside = 64, rows
    n = budgets.count()
    while shift > 0:
        shift = max(0, shift - bits)
        sums = (inside.groupBy("source", F.shiftright("h", shift).alias("bucket"))
                .agg(F.sum("size").alias("w"), F.min("h").alias("lo"), F.max("h").alias("hi"),
                     F.count(F.lit(1)).alias("rows")))
        run = Window.partitionBy("source").orderBy("bucket")  # at most 2^bits rows a source
        sums = (sums.withColumn("upto", F.sum("w").over(run))
                .join(bounded_broadcast(open_.withColumnRenamed("source", "s"), n), F.col("source").eqNullSafe(F.col("s")))
                .filter(F.col("upto") >= F.col("left")))
        edge = sums.groupBy("source").agg(F.min_by(F.struct("bucket", "w", "upto", "lo", "hi", "rows", "left"), "bucket").alias("b"))
        edge = cut(edge.select("source", "b.*", F.lit(shift).alias("shift")), "mix-edge")
        before = F.col("upto") - F.col("w")
        done = (F.col("lo") == F.col("hi")) | (F.lit(shift) == 0)
        # of the equal rows of one hash, the number whose words are nearest to what is left (one row: all or none)
        near = F.floor(F.try_divide(F.col("rows") * (F.col("left") - before), F.col("w")) + 0.5)
        final = edge.filter(done).select(
            "source", "shift", "bucket", (near >= F.col("rows")).alias("take_bucket"),
            F.when(near < F.col("rows"), near).otherwise(0).cast("long").alias("take_rows"))
        keep = final if keep is None else keep.unionByName(final)
        more = edge.filter(~done)
        if not more.take(1):
            break
        nxt = more.select(F.col("source").alias("s"), "bucket", (F.col("left") - before).alias("left"))
        inside = rows.join(bounded_broadcast(nxt, n),
                           F.col("source").eqNullSafe(F.col("s")) & (F.shiftright("h", shift) == F.col("bucket"))
                           ).select("source", "h", "size")
        open_ = nxt.select(F.col("s").alias("source"), "left")
    return keep


def _decisions(rows: DataFrame, weights, max_epochs: int, share: float) -> tuple[DataFrame, int]:
    """One row per source: its size, target, whole epochs and hash threshold; and the number of sources."""
    src = cut(source_weights(rows, weights), "mix-sources")
    plan = cut(with_targets(src, max_epochs, share), "mix-targets")
    n = plan.count()
    size = F.col("source_size")
    plan = plan.withColumn("epochs", F.when(size > 0, F.floor(F.col("target") / size)).otherwise(0).cast("long"))
    # a rest below half a word is rounding
    rest = F.col("target") - F.col("epochs") * size
    budgets = plan.filter(rest >= 0.5).select("source", rest.alias("budget"))
    thr = thresholds(rows.select("source", "h", "size"), budgets)
    side = (plan.join(thr.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")), "left")
            .select(F.col("source").alias("of_source"), "source_size", "target", "epochs", "shift", "bucket",
                    "take_bucket", "take_rows"))
    return cut(side, "mix-decisions"), n


def _copies() -> Column:
    at = F.expr("shiftright(h, shift)")
    below = F.coalesce((at < F.col("bucket")) | ((at == F.col("bucket")) & F.col("take_bucket")), F.lit(False))
    return F.col("epochs") + below.cast("long")


def _with_copies(rows: DataFrame, side: DataFrame) -> DataFrame:
    """``rows`` joined with their decisions, plus ``copies``.

    Where a source takes some of the equal rows of its boundary, these rows
    alone are written, numbered by input partition and position, and the first
    ``take_rows`` get the copy; the window holds the rows of one partition.
    """
    out = rows.withColumn("copies", _copies())
    if not side.filter("take_rows > 0").take(1):
        return out
    at_edge = F.coalesce((F.expr("shiftright(h, shift)") == F.col("bucket")) & (F.col("take_rows") > 0), F.lit(False))
    edge = cut(out.filter(at_edge).withColumn("_u", F.monotonically_increasing_id()), "mix-equal-rows")
    edge = edge.withColumn("_part", F.shiftright("_u", 33))
    per = cut(edge.groupBy(F.col("of_source").alias("_source"), F.col("_part").alias("_p")).agg(F.count(F.lit(1)).alias("_n")),
              "mix-equal-parts")
    upto = F.sum("_n").over(Window.partitionBy("_source").orderBy("_p"))  # at most as many rows a source as partitions
    per = per.select("_source", "_p", (upto - F.col("_n")).alias("_before"))
    nth = F.row_number().over(Window.partitionBy("of_source", "_part").orderBy("_u"))
    edge = (edge.withColumn("_nth", nth)
            .join(bounded_broadcast(per, per.count()),
                  F.col("of_source").eqNullSafe(F.col("_source")) & (F.col("_part") == F.col("_p")))
            .withColumn("copies", F.col("copies") + (F.col("_before") + F.col("_nth") <= F.col("take_rows")).cast("long")))
    return out.filter(~at_edge).unionByName(edge.select(*out.columns))


def mix_plan(rows: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS, share: float = 1.0) -> DataFrame:
    """``rows`` (source, h, size, ...) plus source_size, target and copies (times the row is taken)."""
    side, n = _decisions(rows, weights, max_epochs, share)
    out = rows.join(bounded_broadcast(side, n), F.col("source").eqNullSafe(F.col("of_source")))
    return _with_copies(out, side).select(*rows.columns, "source_size", "target", "copies")


def sized(docs: DataFrame) -> DataFrame:
    """The narrow frame the mix works on: one row per document, no text; written once."""
    return cut(docs.select("doc_id", "source", ordered_hash(F.col("doc_id"), F.col("text")).alias("h"),
                           word_count(F.col("text")).alias("size")), "mix-sized")


def mix(docs: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS, share: float = 1.0) -> DataFrame:
    """``docs`` with every row as often as the mix takes it; columns unchanged. Texts are not shuffled."""
    side, n = _decisions(sized(docs), weights, max_epochs, share)
    cols = docs.columns
    inner = docs.toDF(*[f"c{i}" for i in range(len(cols))])
    key = {c: F.col(f"c{cols.index(c)}") for c in ("doc_id", "source", "text")}
    left = inner.withColumn("h", ordered_hash(key["doc_id"], key["text"]))
    joined = left.join(bounded_broadcast(side, n), key["source"].eqNullSafe(F.col("of_source")))
    taken = _with_copies(joined, side).filter("copies > 0")
    again = taken.withColumn("again", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return again.select(*inner.columns).toDF(*cols)


def op9_mixing(spark, sf_dir):
    """All documents mixed by source: weights 5, 2, 1 repeating, targets up to 3 epochs."""
    plan = mix_plan(sized(read_table(spark, sf_dir, "documents")))
    return plan.select("doc_id", "size", "source_size", "target",
                       (F.col("size") * F.col("copies")).alias("taken"))
