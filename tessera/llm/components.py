"""Connected components of an edge list, on DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import stage


def _state(edges: DataFrame):
    return edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()


def components(edges: DataFrame) -> DataFrame:
    """``(u, v)`` edges -> ``(u, component)`` for every node with an edge;
    ``component`` is the smallest node reachable.

    Alternates the large-star and small-star steps: each node links its
    neighbours to the smallest one it knows.  The number of rounds grows with
    the logarithm of the graph's size.  A step is one partial minimum per
    node and one join whose large keys the skew-join rule can split; every
    round is written to the shared folder.
    """
    cur = stage(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                .where("u > v").distinct(), "edges")
    before = _state(cur)
    while before[0]:
        both = cur.unionByName(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = (both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u > v").distinct())
        large = stage(large, "large-star")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v"))).where("u > v").distinct())
        cur = stage(small, "small-star")
        now = _state(cur)
        if now == before:
            break
        before = now
    return cur.select("u", F.col("v").alias("component"))
