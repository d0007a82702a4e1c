"""Connected components of links by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored


ROWS = 200_000  # edges in a partition


# Both ways of an edge come from one explode, not a union, so that edges few enough for
# one partition stay in it and need no shuffle.


def _pairs(*pairs: tuple[str, str]) -> Column:
    each = [F.struct(F.col(x).alias("x"), F.col(y).alias("y")) for x, y in pairs]
    return F.explode(F.array(*each)).alias("pair")


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the least of its neighbourhood."""
    both = edges.select(_pairs(("a", "b"), ("b", "a"))).select("pair.*").toDF("u", "v")
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    least = least.withColumn("m", F.least("u", "m"))
    return (
        both.filter(F.col("v") > F.col("u")).join(least, "u").select("v", "m").distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the least of them."""
    down = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    near = down.join(least, "u").select(_pairs(("v", "m"), ("u", "m"))).select("pair.*")
    return near.filter(F.col("x") != F.col("y")).distinct()


def _packed(edges: DataFrame, n: int) -> DataFrame:
    """The stored edges in as many partitions as their number asks for."""
    return edges.coalesce(n // ROWS + 1)


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of the edges (a, b), a component being named by
    its least node. Each step shuffles edges only and is stored; the number of steps
    grows with the logarithm of the longest path."""
    names = ["a", "b"]
    edges = edges.toDF(*names).filter(F.col("a") != F.col("b"))
    edges = edges.select(F.greatest(*names), F.least(*names)).toDF(*names).distinct()
    before = None
    while True:
        edges = stored(edges)
        state = edges.agg(
            F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
        edges = _packed(edges, state[0])
        if state == before or not state[0]:
            break
        before = state
        edges = _small_star(_large_star(edges).toDF(*names)).toDF(*names)
    reached = edges.select(_pairs(("a", "b"), ("b", "b"))).select("pair.*").distinct()
    return reached.toDF("node", "component")
