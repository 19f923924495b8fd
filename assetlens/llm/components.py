"""Connected components by alternating large-star and small-star steps over an edge table.

Every step is one minimum per node (combined map-side) and one join back, so a node with very many neighbours
costs one row per task in the aggregation and is split by AQE in the join. The edges of each round are written to the
shared scratch folder; the driver only reads a count and a checksum.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import stored


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node hands its smaller neighbours to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = down.groupBy("u").agg(F.min("v").alias("m"))
    return (down.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
            .union(low.select("u", F.col("m").alias("v"))).distinct())


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node hands its larger neighbours to the smallest node it knows."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return (both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """``(node, root)`` for every node of ``edges`` (columns ``a``, ``b``); root is the smallest node reachable.

    Self-links and null ends are ignored, repeated links count once, no edge gives no row. The edge table shrinks to
    one star per component; it has converged when a whole round leaves it as it was.
    """
    edges = stored(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                   .where("u <> v").distinct(), name)
    seen = None
    while True:
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if state == seen or state[0] == 0:
            break
        seen = state
        edges = stored(_small_star(_large_star(edges)), name)
    return (edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
            .union(edges.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct())
