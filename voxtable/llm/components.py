"""Connected components of a graph by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.expr("sum(cast(xxhash64(hi, lo) as decimal(38, 0)))")).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, root): root is the smallest node that node is linked to, for every node of an edge.

    edges: hi > lo, longs.  A large star links a node's larger neighbours to its smallest one, a small star
    its smaller ones; both keep what is connected.  Rounds are few (the logarithm of the longest path), each
    written to the shared folder, so that nothing grows on the driver and a node with very many neighbours
    is a splittable key of a plain join.
    """
    now = stage(edges.select("hi", "lo").distinct())
    state = _state(now)
    while state[0]:
        both = now.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(now.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
        least = stage(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")))
        large = stage(both.where("v > u").join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct())
        least = stage(large.groupBy("hi").agg(F.min("lo").alias("m")))
        star = large.join(least, "hi")
        now = stage(least.select("hi", F.col("m").alias("lo")).unionByName(star.where("lo > m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))).distinct())
        last, state = state, _state(now)
        if last == state:
            break
    roots = now.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
