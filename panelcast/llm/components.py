"""Connected components of an edge table, by alternating large-star and small-star steps.

Every step is a minimum per vertex (pre-aggregated before its shuffle) and a join back to the
edges, so a vertex with very many links never gathers them in one task. Each round is written to
the shared folder. Empty edge tables give an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.llm.common import written


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Link the larger (large star) or smaller (small star) neighbours of u to the least one; u > v in ``edges``."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else edges
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    if large:
        joined = both.join(least, "u", "left").withColumn("m", F.least("u", F.coalesce("m", F.col("u"))))
        return joined.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    joined = both.join(least, "u")
    rest = joined.where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return rest.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """vertex, component (the least vertex reachable) of every vertex with an edge to another one."""
    held = (edges.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct())
    held = written(held, "edges")
    state = None
    while True:
        held = written(_star(_star(held, large=True), large=False), "star")
        now = held.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == state:
            break
        state = now
    roots = held.select(F.col("v").alias("vertex")).distinct().select("vertex", F.col("vertex").alias("component"))
    return written(held.select(F.col("u").alias("vertex"), F.col("v").alias("component")).unionByName(roots), "components")
