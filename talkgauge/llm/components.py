"""Connected components of a graph held as an edge table.

Every round each node looks at its neighbours and moves to the one with the
smallest hash of the round, itself included; the graph shrinks to the nodes moved
to, and edges inside one are dropped. A random order shrinks long chains as fast
as anything else, by a constant factor a round, and a star in two rounds. Minima
are aggregated before they are shuffled; the joins have a plain equality and read
staged tables on both sides, so that a node with very many edges is split by skew
handling.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talkgauge.plans.staging import stage


def _order(node: Column, turn: int) -> Column:
    return F.struct(F.xxhash64(F.lit(turn), node).alias("h"), node.alias("node"))


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) of all nodes of `edges` (a, b): the smallest node reachable.

    Edges to oneself give a component of one; null ends are not allowed.
    """
    edges = stage(edges.toDF("a", "b"), "edges")
    ends = edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct()
    place = stage(ends.withColumn("at", F.col("node")), "components_0")
    edges = stage(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(),
                  "edges_0")
    turn = 0
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a"))
        moves = stage(both.groupBy("a").agg(F.min(_order(F.col("b"), turn)).alias("best")).select(
            F.col("a").alias("old"), F.least("best", _order(F.col("a"), turn))["node"].alias("new")), f"moves_{turn}")
        edges = stage(edges.join(moves, F.col("a") == F.col("old")).select(F.col("new").alias("a"), "b").join(
            moves, F.col("b") == F.col("old")).select("a", F.col("new").alias("b")).where("a <> b").select(
            F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), f"edges_{turn + 1}")
        place = stage(place.join(moves, F.col("at") == F.col("old"), "left").select(
            "node", F.coalesce("new", "at").alias("at")), f"components_{turn + 1}")
        turn += 1
    smallest = stage(place.groupBy("at").agg(F.min("node").alias("component")), "components_least")
    return place.join(smallest, "at").select("node", "component")
