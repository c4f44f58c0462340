"""Connected components of a large edge list by alternating large-star and small-star steps."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeworks.llm.skew import dealt_anew
from gaugeworks.session import cut_lineage


def connected(edges: DataFrame, cut: Callable[[DataFrame], DataFrame] = cut_lineage) -> DataFrame:
    """``(node, root)`` for every node of the edges ``(u, v)``; root is the least node reachable.

    Every step is a minimum per node (aggregated before the shuffle) and a join back to the
    edges, where adaptive execution splits a node that holds many of them. The number of
    steps grows with the logarithm of the longest chain. Only counts reach the driver.
    Loops and repeated edges are allowed; no edges give no rows. ``cut`` materialises a step.
    """
    held = cut(edges.filter("u != v").select("u", "v").distinct())
    before = None
    while True:
        both = held.unionByName(held.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(dealt_anew("u"), F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u != v").distinct()
        lower = large.groupBy("u").agg(F.min("v").alias("m")).select(dealt_anew("u"), "m")
        small = (
            large.join(lower, "u")
            .select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
            .select("e.u", "e.v")
            .filter("u != v")
            .distinct()
        )
        held = cut(small)
        now = held.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    roots = held.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return held.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
