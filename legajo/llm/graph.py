"""Connected components of a link table, with the hot nodes left spread."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from legajo.llm.scratch import saved


def components(links: DataFrame) -> DataFrame:
    """(node, component): the smallest node that each linked node can reach.

    ``links`` has the long columns ``a`` and ``b``; nulls and loops are left out, repeats and either
    direction do no harm. Links are turned towards the smallest neighbour, alternately seen from both
    ends and from the larger one, until every node points at its component: a number of rounds that
    grows with the logarithm of the longest chain. Minima are aggregates and the rest are joins, so no node's links
    are gathered; each round is written to the shared folder and only its count and hash reach the driver.
    """
    edges = links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges, before = saved(edges, "links"), None
    while True:
        state = edges.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))")).first()
        if state == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
                edges.select("v", "v").distinct()
            )
        before = state
        both = edges.union(edges.select("v", "u"))
        low = both.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("m"))
        low = low.select("node", F.least("node", "m").alias("m"))
        large = both.join(low, both["u"] == low["node"]).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # A node can be its own minimum seen from both ends; such loops carry nothing.
        large = saved(large.filter("u <> v").distinct(), "links")
        low = large.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("m"))
        small = large.join(low, large["u"] == low["node"]).filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = saved(small.union(low.select("node", "m")).distinct(), "links")
