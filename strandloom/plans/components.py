"""Connected components by alternating large-star and small-star rounds (Kiveris et al., 2014).

Every round is two aggregations and two equi-joins; no neighbour list is ever gathered, so a hub
with a third of all edges is only a skewed join key, which AQE splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandloom.plans.lineage import mark, release, stored, tasks_for


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst", max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of an edge; component is the smallest node reachable.

    Null ends and self loops carry no link; a node that has only those is absent, as isolated nodes are. Each round's edges
    are stored and those of the round before deleted.
    """
    spark, since = edges.sparkSession, mark()
    a, b = F.col(src), F.col(dst)
    e = stored(edges.where(a != b).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")))
    with tasks_for(spark, 2 * e.count()):
        e = _settle(e, since, max_rounds)
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )


def _settle(e: DataFrame, since: int, max_rounds: int) -> DataFrame:
    """Links (u, v), u > v, brought to stars around the least node of each component."""
    spark, seen = e.sparkSession, None
    for _ in range(max_rounds):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        pairs = F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct(F.col("u"), F.col("m").alias("v"))))
        e = stored(large.join(low, "u").select(pairs.alias("e")).select("e.u", "e.v").where("u != v").distinct())
        release(spark, since, keep=1)
        now = e.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == seen:
            return e
        seen = now
    raise RuntimeError(f"components did not settle within {max_rounds} rounds")
