"""Connected components of an edge table, by alternating star contractions.

Each round points all neighbours of a node at its least neighbour (large star:
those greater than the node; small star: those not greater). Both are one
mergeable minimum per node and one join, written to the shared folder, so no
adjacency list is ever gathered and a hub's rows may be split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import materialize, release


def _star(edges: DataFrame, large: bool) -> DataFrame:
    if large:
        pairs = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        pairs = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = pairs.groupBy("a").agg(F.min("b").alias("_m")).select("a", F.least("a", "_m").alias("_m"))
    joined = pairs.join(least, "a")
    if large:
        out = joined.where("b > a").select(F.col("b").alias("a"), F.col("_m").alias("b"))
    else:
        out = joined.select(F.col("b").alias("a"), F.col("_m").alias("b")) \
            .union(least.select("a", F.col("_m").alias("b")))
    return out.where("a != b").distinct()


def _digest(edges: DataFrame):
    return edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``edges``: columns a, b of one orderable type. Returns node, root (the
    least node reachable) for every node that has an edge to another."""
    spark = edges.sparkSession
    e, path = materialize(edges.select("a", "b").where("a != b").distinct(), "edges")
    seen = _digest(e)
    for k in range(max_rounds):
        after, new = materialize(_star(_star(e, True), False), f"stars{k}")
        release(spark, path)
        e, path, before, seen = after, new, seen, _digest(after)
        if seen == before:
            return e.select(F.col("a").alias("node"), F.col("b").alias("root"))
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
