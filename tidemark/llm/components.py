"""Connected components of an edge table by alternating star rewrites.

Each round is two min-aggregations and two equi joins; a hub is never gathered, since only the minimum of
its neighbours is kept (map-side combined) and the join sends one row to it. The number of rounds grows
with the logarithm of the component size. Every round is a table in the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import materialize


def _star(pairs: DataFrame, large: bool) -> DataFrame:
    """Link each node's neighbours (the larger ones, or the smaller ones) to its smallest neighbour."""
    if large:
        both = pairs.select("u", "v").union(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        joined = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        return joined.filter("u <> v").distinct()
    least = pairs.groupBy("u").agg(F.min("v").alias("m"))
    moved = pairs.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    own = least.select("u", F.col("m").alias("v"))
    return moved.union(own).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges`` (src, dst: non-null longs) to rows (node, root): the smallest node of the component.

    Only nodes with an edge to another node appear. An empty edge table gives an empty result.
    """
    pairs = edges.filter("src <> dst").select(
        F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v")
    )
    pairs = materialize(pairs.distinct(), "cc")
    before = None
    while True:
        state = pairs.agg(
            F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")
        ).first()
        if state["n"] == 0 or (state["n"], state["h"]) == before:
            break
        before = (state["n"], state["h"])
        pairs = materialize(_star(_star(pairs, large=True), large=False), "cc")
    roots = pairs.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.union(pairs.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
