"""Connected components of a link table by alternating large-star and small-star steps.

Each step is an aggregate and a join on the node; a node with a third of all
links is split by the skew join. No link or label goes to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import cut


def _star(links: DataFrame, large: bool) -> DataFrame:
    if large:
        pairs = links.select("u", "v").unionAll(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        pairs = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = pairs.groupBy("u").agg(F.min("v").alias("m"))
    least = least.select(F.col("u").alias("n"), F.least("u", "m").alias("m"))
    near = pairs.join(least, F.col("u") == F.col("n"))
    out = near.filter(F.col("v") > F.col("u") if large else F.col("v") != F.col("m")).select(
        F.col("v").alias("u"), F.col("m").alias("v"))
    if not large:
        out = out.unionAll(least.select(F.col("n").alias("u"), F.col("m").alias("v")))
    return out.filter("u != v").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node of ``links`` (u, v): root is the smallest node of its component.

    Direction, repeats and loops do not matter; an empty table has no nodes.
    """
    now = cut(links.select("u", "v").filter("u != v").distinct(), "links")
    before = None
    while True:
        state = now.agg(F.count(F.lit(1)), F.sum(F.pmod(F.xxhash64("u", "v"), F.lit(1 << 40)))).first()
        if not state[0] or state == before:
            break
        before = state
        now = cut(_star(_star(now, True), False), "links")
    roots = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionAll(now.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()
