"""Connected components by alternating star operations on a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.session import materialise


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable, for every node on an edge (a, b).

    Each round hangs the larger neighbours of a node on its smallest neighbour, then the
    smaller ones; every edge moves closer to its root and none joins two components. A round
    is two aggregations and two joins over edges, whatever the shape of the graph, and its
    result is written to the shared folder, so a lost executor costs one round. An empty table gives an
    empty one; edges from a node to itself make that node its own component.
    """
    own = edges.where("a = b").select(F.col("a").alias("node"))
    edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b").distinct()
    edges = materialise(edges, "edges")
    state = _state(edges)
    while True:
        both = edges.union(edges.select("b", "a")).toDF("u", "v")
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = materialise(small.union(least.select("a", "m")).where("a > b").distinct(), "edges")
        now = _state(edges)
        if now == state:
            break
        state = now
    members = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component"))
    alone = own.select("node", F.col("node").alias("component"))
    return members.union(roots).union(alone).groupBy("node").agg(F.min("component").alias("component"))


def _state(edges: DataFrame):
    return edges.agg(
        F.count("*"), F.expr("bit_xor(xxhash64(a, b))"), F.sum(F.expr("cast(xxhash64(b, a) as decimal(20,0))"))).first()
