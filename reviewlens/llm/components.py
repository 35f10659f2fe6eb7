"""Connected components of an edge table by alternating stars, as joins and minimum aggregates.

A round joins every node's neighbours to the smallest one it knows: first neighbours larger than the node
(large star), then smaller ones (small star). Each round is written to the shared scratch folder. The
minima are aggregated before the shuffle, and the joins have one row per node on the other side, so that
adaptive execution can split a hub; no neighbour list is ever gathered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlens.llm.common import stored


def _smallest(edges: DataFrame) -> DataFrame:
    return stored(edges.groupBy("u").agg(F.min("v").alias("m")), "minima")


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
    return row.n, row.x


def _proper(u, v, edges: DataFrame) -> DataFrame:
    return edges.select(u.alias("u"), v.alias("v")).where("u <> v").distinct()


def connected_components(edges: DataFrame, u: str = "u", v: str = "v") -> DataFrame:
    """(node, component) for every node with an edge; component is the smallest node it reaches.

    Edges may repeat and point either way; those with a null end and loops are ignored. An empty edge
    table gives an empty result. Nodes can be of any type that has an order.
    """
    one, two = F.col(u), F.col(v)
    known = edges.where(one.isNotNull() & two.isNotNull())
    current = stored(_proper(F.greatest(one, two), F.least(one, two), known), "edges")
    mark = _mark(current)
    while mark[0]:
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        met = both.join(_smallest(both), "u").where("v > u")
        large = stored(_proper(F.col("v"), F.least("u", "m"), met), "large-star")

        met = large.join(_smallest(large), "u")
        small = met.select("v", "m").union(met.select("u", "m")).toDF("v", "m")
        current = stored(_proper(F.col("v"), F.col("m"), small), "small-star")

        before, mark = mark, _mark(current)
        if before == mark:
            break
    return current.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
