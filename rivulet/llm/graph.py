"""Connected components by alternating large-star and small-star steps, each a pre-aggregated shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.llm.common import settle

SALTS = 16


def _with_minimum(edges: DataFrame, low: DataFrame, key: str, other: str) -> DataFrame:
    """Edges with m, their key's minimum, where ``low`` has one. A hub's edges are dealt over SALTS tasks."""
    dealt = edges.withColumn("salt", F.pmod(F.xxhash64(other), F.lit(SALTS)).cast("int"))
    copies = low.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return dealt.join(copies, [key, "salt"], "left").drop("salt")


def connected_components(edges: DataFrame, max_steps: int = 60) -> DataFrame:
    """(node, component) for every node that an edge (a, b) touches; component is the smallest node id reachable.

    Each step rewires edges towards the smallest neighbour, so a group of any size becomes a star in a logarithmic
    number of steps. Minimums are combined before the shuffle, and only those of nodes whose edges they change are joined
    back (a star's centre and its ends have none), salted, so one large group loads no single task. Loops and repeated
    edges have no effect. An empty edge table gives an empty result.
    """
    e = settle(edges.select(F.greatest("a", "b").cast("long").alias("u"), F.least("a", "b").cast("long").alias("v")).where("u != v").distinct())
    mark = None
    for _ in range(max_steps):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m"), F.max("v").alias("top")).where("m < u and u < top").select(F.col("u").alias("v"), "m")
        large = _with_minimum(e, low, "v", "u").select("u", F.coalesce("m", "v").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"), F.max("v").alias("top")).where("m < top").select("u", "m")
        joined = _with_minimum(large, low, "u", "v").withColumn("m", F.coalesce("m", "v"))
        small = joined.select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        e = settle(small.where("u != v").distinct())
        now = e.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if mark == (now["n"], now["h"]):
            break
        mark = (now["n"], now["h"])
    else:
        raise RuntimeError(f"components did not settle in {max_steps} steps")
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
