"""Connected components by alternating large-star and small-star steps over an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .support import saved


def _smallest(pairs: DataFrame) -> DataFrame:
    """``u, m``: the least of each node and its neighbours in ``pairs(u, v)``."""
    return pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Link the larger neighbours of each node to its least neighbour."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    linked = both.filter("v > u").join(_smallest(both), "u")
    return linked.select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link each node, and its smaller neighbours, to the least of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = _smallest(down)
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, root``: the least node reachable from each node that has an edge in ``edges(u, v)``.

    Loops and repeated edges are harmless; nodes without edges don't appear.  Each round is saved in the
    shared checkpoint folder; the rounds needed grow with the logarithm of the longest path at most squared.
    """

    def digest(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())

    now = saved(edges.filter("u <> v").select("u", "v").distinct())
    seen = digest(now)
    while seen[0]:
        now = saved(_small_star(_large_star(now)))
        last, seen = seen, digest(now)
        if seen == last:
            break
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
