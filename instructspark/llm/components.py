"""Connected components by repeated contraction, as joins and aggregations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from instructspark.llm.common import drop, store


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, root`` for each node of the edges ``a, b``: root is the least node reachable.

    In each round every node takes the least of itself and its neighbours, and edges are
    carried over to those.  A node with an edge takes another or is taken, so at least
    half of the nodes go in a round, and the tables shrink with them.  Minima combine
    before the shuffle, so a node may have any number of edges.
    """
    left = store(edges.select("a", "b").where(F.col("a") != F.col("b")).distinct(), "edges")
    moves = []
    while not left.isEmpty():
        both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("to"))
        move = store(least.withColumn("to", F.least("node", "to")), "moves")
        moves.append(move)
        for side in ("a", "b"):
            name = move.select(F.col("node").alias(side), F.col("to").alias("_to"))
            left = left.join(name, side).drop(side).withColumnRenamed("_to", side)
        earlier = left
        left = store(left.where(F.col("a") != F.col("b")).distinct(), "edges")
        drop(earlier)
    if not moves:
        return left.select(F.col("a").alias("node"), F.col("b").alias("root"))

    def follow(known: DataFrame, move: DataFrame) -> DataFrame:
        later = move.select(F.col("node").alias("root"), "to")
        return known.join(later, "root", "left").select(
            "node", F.coalesce("to", "root").alias("root")
        )

    first = moves[0].withColumnRenamed("to", "root")
    found = store(reduce(follow, moves[1:], first), "components")
    drop(left, *moves)
    return found
