"""Connected components by alternating large-star and small-star rounds, as joins and combining aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm.store import Store


def _star(store: Store, edges: DataFrame, large: bool) -> DataFrame:
    """Each node's larger (large) or smaller neighbours, and in the latter case itself, linked to the least of node and neighbours."""
    both = edges.select("u", "v").union(edges.select("v", "u")) if large else edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = store.keep(both.groupBy(F.col("u").alias("w")).agg(F.least(F.min("v"), F.min("u")).alias("m")))
    joined = both.join(least, F.col("u") == F.col("w"))
    new = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")) if large else joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select(F.col("w").alias("u"), F.col("m").alias("v")))
    out = store.keep(new.where("u <> v").distinct())
    store.drop(least)
    return out


def components(store: Store, edges: DataFrame) -> DataFrame:
    """(node, root): for each node of edges(u, v) but the roots themselves, the least node that it reaches."""
    edges = store.keep(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    while True:
        # done once each node has one edge, and the node there none
        ends = edges.select(F.col("u").alias("x"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(edges.select("v", F.lit(0), F.lit(1)))
        if ends.groupBy("x").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up > 1 or up = 1 and down = 1").isEmpty():
            roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
            store.paths[id(roots)] = store.paths.pop(id(edges))
            return roots
        one = _star(store, edges, large=True)
        two = _star(store, one, large=False)
        store.drop(edges, one)
        edges = two.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        store.paths[id(edges)] = store.paths.pop(id(two))
