"""Connected components of a large edge list, as rounds of joins and minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelkpi.llm.common import written


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the least node reachable from each node of `edges` (u, v); a root has no row.

    Alternating large-star and small-star steps: every node's larger (then
    smaller) neighbours are hung on its least neighbour, until no edge changes;
    the stars that are left are the components. The number of rounds grows with
    the logarithm of the graph. Each round is written below the shared folder.
    """

    def star(pairs: DataFrame, keep) -> DataFrame:
        least = pairs.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        return pairs.join(least, "u").where(keep).select(F.col("v").alias("u"), F.col("m").alias("v"))

    now = written(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                  .distinct(), "components")
    held = _sum(now)
    while held[0]:
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = star(both, F.col("v") > F.col("u")).where("u <> v").distinct()
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        small = (down.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(least.select("u", F.col("m").alias("v"))).distinct())
        now = written(small, "components")
        if (after := _sum(now)) == held:
            break
        held = after
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _sum(edges: DataFrame) -> tuple:
    """Number of edges and an order-free digest: equal when nothing changed."""
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % 1_000_000_007)).first())
