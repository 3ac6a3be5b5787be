"""Connected components by alternating large-star and small-star steps.

Nothing is collected: each round is joins and map-side combined minima over the edge table, written to the
shared folder. A node with very many neighbours is only ever a join key, which adaptive execution can split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import Scratch


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """Edges (u, v) of any orderable type -> (node, component): the smallest node that links reach.

    Direction, repeats and self-loops don't matter; rows with a null end are no edges. Only nodes that have
    an edge to another node are returned.
    """
    e = scratch.table(
        edges.where("u <> v")
        .select(F.greatest("u", "v").alias("a"), F.least("u", "v").alias("b"))
        .distinct()
    )
    seen = None
    while True:
        stat = e.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
        state = (stat["n"], stat["s"])
        if state == seen or not state[0]:
            return e.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
                e.select("b", "b").distinct()
            )
        seen = state
        both = e.select(F.col("a").alias("u"), F.col("b").alias("v")).union(e.select("b", "a"))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(least, "a")
            .where("b <> m")
            .select(F.col("b").alias("a"), F.col("m").alias("b"))
            .union(least.select("a", "m"))
            .distinct()
        )
        after = scratch.table(small)
        scratch.drop(e)
        e = after
