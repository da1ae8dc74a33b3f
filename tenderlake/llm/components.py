"""Connected components of a graph in a DataFrame, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def _both(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node's larger neighbours are linked to the smallest of the node and its neighbours."""
    near = _both(edges)
    # written, both sides of the join are plain exchanges, and Spark can split the rows of a hub
    least = written(near.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
    return near.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours are linked to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = written(down.groupBy("u").agg(F.min("v").alias("m")), "least")
    moved = down.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v")))


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(u, root) for every node with an edge that is not its component's smallest node.

    edges has columns u and v of one ordered type. Each round is written to the
    shared folder, so lineage stays short and lost executors cost no earlier round.
    """
    at = written(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    size = at.count()
    if not size:
        return at.select("u", F.col("v").alias("root"))
    for _ in range(rounds):
        before, last = at, size
        at = written(_small_star(_large_star(at)).distinct(), "edges")
        size = at.count()
        # edges are distinct, so as many of them with none that is new are the same ones
        if size == last and at.join(before, ["u", "v"], "left_anti").isEmpty():
            return at.select("u", F.col("v").alias("root"))
    raise RuntimeError(f"components have not settled in {rounds} rounds")
