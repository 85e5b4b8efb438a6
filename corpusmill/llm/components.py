"""Connected components by alternating large-star and small-star steps on an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.common import written


def _digest(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(edges: DataFrame) -> DataFrame:
    """node, component of every end of an edge (u, v: long); component is the smallest node reachable.

    Each step keeps minima alone, by aggregates that combine before the shuffle. Steps are
    written tables, so that no lineage grows and lost executors cost one step, and so that
    the joins stand by themselves: the edges of a hub with very many neighbours are then
    split among tasks as skewed, which they aren't where a join shares an aggregate's shuffle.
    The number of rounds grows with the logarithm of the longest path. Only a count and a
    checksum go to the driver. Loops, repeated edges and an empty table are allowed.
    """
    now = written(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u > v").distinct(), "edges")
    seen = _digest(now)
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = written(both.groupBy("u").agg(F.least(F.first("u"), F.min("v")).alias("m")), "least")
        large = written(both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "large")
        lowest = written(large.groupBy("u").agg(F.min("v").alias("m")), "lowest")
        small = large.join(lowest, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = written(small.union(lowest).where("u > v").distinct(), "edges")
        found = _digest(now)
        if found == seen:
            break
        seen = found
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(now.select("v", "v")).distinct()
