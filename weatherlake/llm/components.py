"""Connected components of an edge table, without collecting the graph.

Alternating large-star and small-star steps: every step is one keyed minimum
(combined before the shuffle, so a hub with a third of all edges sends one row
per task) and one equi-join that adaptive execution can split on the hub.  The
frame is checkpointed after each pair of steps; the loop ends when only stars
around smallest nodes are left.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from weatherlake.llm.shared import cut


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    least = both.groupBy("src").agg(F.min("dst").alias("m")).select("src", F.least("src", "m").alias("m"))
    return both.filter("dst > src").join(least, "src").select(F.col("dst").alias("src"), F.col("m").alias("dst"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst"))
    least = down.groupBy("src").agg(F.min("dst").alias("m"))
    moved = down.join(least, "src")
    return (moved.filter("dst <> m").select(F.col("dst").alias("src"), F.col("m").alias("dst"))
            .unionByName(least.select("src", F.col("m").alias("dst"))))


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges``: src, dst (longs).  Returns ``node``, ``component`` (the
    smallest node reachable) for every node that has an edge to another one.
    Null ends and self-loops are ignored; no edges give an empty frame."""
    e = cut(edges.filter("src <> dst")
            .select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst")).distinct())
    while True:
        e = cut(_small_star(_large_star(e).distinct()).distinct())
        if _only_stars(e):
            return e.select(F.col("src").alias("node"), F.col("dst").alias("component"))


def _only_stars(edges: DataFrame) -> bool:
    """Every source has one edge and no target is a source."""
    twice = edges.groupBy("src").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("src")
    inner = edges.select(F.col("dst").alias("src")).distinct().join(edges.select("src"), "src", "left_semi")
    return twice.unionByName(inner).isEmpty()
